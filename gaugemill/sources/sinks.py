"""Sinks: items, send order, the append-only result table, manifests."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .config import ConfigError

#: Buckets of a new table of records, unless another number is given.
BUCKETS = 16
#: Settings that a resumed run must share with the run it goes on with.
PINNED = ("prompt", "prompt_sha", "schema_sha", "key_order", "guided", "mode", "seed", "decoding")


def write_items(items: DataFrame, path: str, origin: dict | None = None) -> None:
    """Items as JSON lines in order of their id; the committer makes the write all or nothing.

    ``origin`` (see provenance) is kept beside them as ``_items.json``, which Spark's readers pass over.
    """
    items.orderBy("id").write.mode("overwrite").json(path)
    if origin is not None:
        write_json(items.sparkSession, f"{path}/_items.json", origin)


def write_order(plan: DataFrame, path: str) -> None:
    plan.select(F.col("ord").alias("order"), "id", "group", "stratum", "weight").orderBy("order").write.mode("overwrite").csv(path, header=True)


@contextmanager
def as_table(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> Iterator[str]:
    """The name of a table of the session, bucketed by ``key``, over the files at ``path``, for as long as it is used.

    It is external, so only its name goes in the end; frames made of it stay valid.
    """
    name = f"gaugemill_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


def read_table_of(spark: SparkSession, path: str) -> DataFrame | None:
    """The records at ``path``, None if there are none yet.

    They are bucketed by key, so that joins and groups by key shuffle none of them.
    """
    files, place = store_of(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
    if not any(n.endswith(".parquet") for n in names):
        return None
    plain, layout = spark.read.parquet(path), read_json(spark, f"{path}/_run/layout.json")
    if layout is None:
        return plain  # from before records were bucketed, or written by others
    with as_table(spark, path, plain.schema, layout["buckets"]) as name:
        return spark.table(name)


def append_results(results: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Appends records; a failed or repeated task leaves no partial rows.

    A new table is bucketed by ``key``, one file a bucket each time; an older one is gone on with as it is.
    """
    spark = results.sparkSession
    layout = read_json(spark, f"{path}/_run/layout.json")
    if layout is None and read_table_of(spark, path) is not None:
        results.write.mode("append").parquet(path)
        return
    if layout is None:
        layout = {"buckets": buckets}
        write_json(spark, f"{path}/_run/layout.json", layout)
    with as_table(spark, path, results.schema, layout["buckets"]) as name:
        results.repartition(layout["buckets"], "key").write.insertInto(name)


@contextmanager
def locked(spark: SparkSession, path: str, patience: float = 600.0, stale: float = 1800.0) -> Iterator[None]:
    """Holds the lock file ``path``, which only one of several drivers can make; waits for it with ``patience``.

    A lock that is older than ``stale`` seconds was left by a driver that died, and is taken away.
    """
    files, place = store_of(spark, path)
    until = time.monotonic() + patience

    def make() -> None:
        if files.getScheme() == "file":  # whose create() looks first and makes after, which isn't one step
            name = place.toUri().getPath()
            os.makedirs(os.path.dirname(name), exist_ok=True)
            os.close(os.open(name, os.O_CREAT | os.O_EXCL))
        else:
            files.create(place, False).close()

    while True:
        try:
            make()
            break
        except (Py4JJavaError, FileExistsError):
            if not files.exists(place):
                continue  # it went meanwhile
            if time.time() - files.getFileStatus(place).getModificationTime() / 1000 > stale:
                files.delete(place, False)
            elif time.monotonic() > until:
                raise ConfigError(f"another run has held {path} for {patience:.0f} s") from None
            else:
                time.sleep(0.2)
    try:
        yield
    finally:
        files.delete(place, False)


def append_new(results: DataFrame, path: str, after: int | None = None, seen: int | None = None, buckets: int = BUCKETS) -> int:
    """Appends records whose key no one else has recorded meanwhile; how many were appended.

    The records are numbered behind the place (``seq``) ``after``, and ``seen`` is the last place of all that they were planned
    with (``after`` unless it is given): keys recorded behind that, by a run that overlapped, are left as they are, and the new
    records are numbered behind all of those. Without ``after`` any record of a key stands in the way. Records are worked out and written aside first; the lock is held only while keys are compared and
    files are added, so that of runs that overlap each key is recorded once.
    """
    spark = results.sparkSession
    aside = scratch(spark, "results")
    results.write.parquet(aside)
    staged = spark.read.schema(results.schema).parquet(aside)
    staged = staged.dropDuplicates(["key"]) if after is None else staged
    with locked(spark, f"{path}/_run/lock"):
        there = read_table_of(spark, path)
        if there is not None:
            seen = after if seen is None else seen
            newer = there if seen is None else there.where(F.col("seq") > seen)
            last = there.agg(F.max("seq")).first()[0]
            shift = last - after if after is not None and last is not None and last > seen else 0
            staged = staged.join(newer.select("key").distinct(), "key", "left_anti").withColumn("seq", F.col("seq") + shift).select(*results.columns)
        n = staged.count()
        if n:
            append_results(staged, path, buckets)
    remove(spark, aside)
    return n


def append_stream(results: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Appends a stream of records, each key once, also where a batch is repeated or another stream has it too."""

    def put(batch: DataFrame, _: int) -> None:
        append_new(batch, path, buckets=buckets)

    return results.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()


def store_of(spark: SparkSession, path: str):
    """The file system that Spark reads ``path`` with, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def absolute(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as processes other than Spark's read it."""
    files, place = store_of(spark, path)
    return files.makeQualified(place).toString().replace("file:/", "file:///", 1) if files.getScheme() == "file" else files.makeQualified(place).toString()


def remove(spark: SparkSession, path: str) -> None:
    files, place = store_of(spark, path)
    files.delete(place, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: in the checkpoint folder, else in the warehouse.

    Sessions within one machine that name no checkpoint folder take a temporary folder of it.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="gaugemill-") if spark.sparkContext.master.startswith("local") else spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text in any store that Spark writes to, whole or not at all."""
    files, place = store_of(spark, path)
    part = place.suffix(f".{uuid.uuid4().hex}")
    out = files.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(place, False)
    files.rename(part, place)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text that write_text left, None if there is none."""
    files, place = store_of(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    write_text(spark, path, json.dumps(value, indent=2, ensure_ascii=False, default=str))


def read_json(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, path)
    return None if text is None else json.loads(text)


def provenance(spec_text: str, sizes: dict[str, int], seed: int, rows: int, inputs: dict[str, str]) -> dict:
    """Where items come from; ``inputs`` maps files to their hashes."""
    return {"spec_sha": hashlib.sha256(spec_text.encode()).hexdigest(), "sizes": sizes, "seed": seed, "rows": rows, "inputs": inputs}


def check_manifest(old: dict | None, new: dict, session: dict) -> dict:
    """The manifest of a run that goes on with ``old``; pinned settings must agree.

    The longest reply may change, since a reply that was cut off is an error and never a verdict.
    """
    if old is not None:
        settled = lambda m, k: {a: b for a, b in (m.get(k) or {}).items() if a != "max_tokens"} if k == "decoding" else m.get(k)
        if changed := [k for k in PINNED if settled(old, k) != settled(new, k)]:
            raise ConfigError(f"the run was started with other values of {', '.join(changed)}")
    return (old or {}) | new | {"sessions": [*(old or {}).get("sessions", []), session]}
