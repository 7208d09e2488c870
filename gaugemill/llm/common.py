"""Small helpers that the training-data operators share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows and bytes of an Arrow batch that are worked on at a time; texts can be long, so these are few.
BATCH_ROWS, BATCH_BYTES = 256, 4 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for ``name``, in this application's part of the shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is visible to every executor. Where it is unset, the
    warehouse takes its place, but for sessions within one machine (tests), which take a temporary folder
    of it. The folders stay until ``clear``, since lazily read results depend on them.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("gaugemill.scratch", None)
    if not root:
        alone = re.match(r"local(\[|$)", spark.sparkContext.master)
        root = "file://" + tempfile.mkdtemp(prefix="gaugemill-") if alone else spark.conf.get("spark.sql.warehouse.dir")
        spark.conf.set("gaugemill.scratch", root)
    return f"{root.rstrip('/')}/gaugemill-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Removes all that this application has left in scratch folders; for when results are written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark, "x")).getParent()
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and its lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of BATCH_ROWS rows and about BATCH_BYTES bytes at most; a row is never cut.

    So what a function holds for its rows is bounded whatever the session's settings are, which are left alone.
    """
    for batch in batches:
        upto = 0
        while upto < batch.num_rows:
            rows = min(BATCH_ROWS, batch.num_rows - upto)
            while rows > 1 and batch.slice(upto, rows).nbytes > BATCH_BYTES:
                rows = -(-rows // 2)
            yield batch.slice(upto, rows)
            upto += rows


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often ``use`` names it.

    Without this an expression named inside a lambda of a higher-order function would be
    evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def file_system(uri: str):
    """pyarrow's file system for ``uri`` and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, write: Callable) -> None:
    """Writes ``uri`` under a name of its own and renames it: a retried task leaves whole files."""
    files, path = file_system(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        write(out)
    files.move(part, path)


def others(df: DataFrame, names) -> list[str]:
    """The columns of ``df`` but for those of the given names, in either case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def adding(df: DataFrame, inputs: list[str], fields: dict[str, T.DataType], make: Callable, without: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns ``fields``, computed by Arrow batches in Python.

    ``make()`` is called once a task and gives a function from the input columns, as lists, to the
    new columns, as lists or arrays. Columns of these names that the table has already are
    replaced; those in ``without`` are dropped.
    """
    kept = others(df, [*fields, *without])
    extra = [c for c in dict.fromkeys(inputs) if c not in kept]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"__input_{c}") for c in extra])
    places = [kept.index(c) if c in kept else len(kept) + extra.index(c) for c in inputs]
    schema = T.StructType([f for f in rows.schema.fields[: len(kept)]] + [T.StructField(k, v) for k, v in fields.items()])
    kinds = [to_arrow_type(v) for v in fields.values()]
    names = schema.names

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = make()
        for batch in sliced(of):
            made = use(*[batch.column(i).to_pylist() for i in places])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *(pa.array(c, k) for c, k in zip(made, kinds))], names)

    return rows.mapInArrow(run, schema)
