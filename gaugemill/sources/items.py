"""Sources of rows and items, and the checks that refuse a bad pool before anything is sent."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import file_name, whole_json
from .sinks import scratch

#: Columns of a CSV pool that are no fields.
RESERVED = ("id", "group", "stratum", "weight")
#: Counts of splits are broadcast up to so many rows, and joined by shuffle beyond.
BROADCAST_SPLITS = 200_000
#: Bytes of a file that are hashed at a time.
CHUNK = 8 << 20


class ItemsError(ValueError):
    """A pool that is refused, with the reason."""


def read_table(spark: SparkSession, path: str, breaks: bool = True, **options) -> DataFrame:
    """A CSV table: every cell is text, a byte order mark is understood.

    With ``breaks`` cells may hold line breaks, and a file is one task; say False for large files whose
    rows are lines, so that they are split.
    """
    return spark.read.options(header=True, multiLine=breaks, escape='"', **options).csv(path)


def read_folder(spark: SparkSession, path: str, breaks: bool = True, **options) -> DataFrame:
    """All CSV files of a folder but pool manifests, with ``file_name``; one pass for all files."""
    rows = read_table(spark, path, breaks, pathGlobFilter="*.csv", **options)
    rows = rows.withColumn("file_name", file_name(F.col("_metadata.file_path")))
    return rows.where(~F.col("file_name").rlike(r"_pool(?:\.[^.]*)?$"))


def positioned(df: DataFrame, to: str = "pos", within: str | None = None) -> DataFrame:
    """Adds the 0-based place of each row among the rows of the files read one after another, by their paths.

    A scan packs splits of files into tasks by size, so tasks say nothing of order. Rows are counted by
    split (file and first byte) first, one small row each, which is written; a split's rows start behind those of
    all splits before it. No row of the source is shuffled or sorted. Rows that come from no files have the
    order of their partitions; rows whose files can't be told any more, as after a join, are refused.

    ``within`` adds a struct as well: ``file``, the number of the row's file among all files that have rows, and
    ``place``, the row's place in it.
    """
    spark, here = df.sparkSession, F.monotonically_increasing_id().alias("__id")
    columns = [F.col(f"`{c}`") for c in df.columns]
    try:
        cut = df.select(*columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), here)
    except AnalysisException:
        if df.inputFiles():
            raise ItemsError("rows that were joined or sorted since their files were read have no places") from None
        cut = df.select(*columns, F.lit("").alias("__file"), F.spark_partition_id().cast("long").alias("__block"), here)
    # One row a split, as many as the driver has listed to plan the scan.
    splits = cut.groupBy("__file", "__block").agg(F.count("*").alias("n"), F.min("__id").alias("__first"))
    order = Window.orderBy("__file", "__block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counted = splits.select(
        "__file", "__block", "__first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"),
        (F.dense_rank().over(Window.orderBy("__file")) - 1).alias("__number"), F.coalesce(F.sum("n").over(own), F.lit(0)).alias("__own"),
    )
    path = scratch(spark, "splits")
    counted.coalesce(1).write.parquet(path)
    starts = spark.read.schema(counted.schema).parquet(path)
    few = starts.count() <= BROADCAST_SPLITS
    at = cut.join(F.broadcast(starts) if few else starts, ["__file", "__block"], "left")
    step = F.col("__id") - F.coalesce("__first", F.raise_error(F.lit("the files were read in other splits than they were counted in")).cast("long"))
    both = F.struct(F.col("__number").alias("file"), (F.col("__own") + step).alias("place"))
    return at.select(*columns, (F.col("__start") + step).alias(to), *([both.alias(within)] if within else []))


def csv_items(spark: SparkSession, path: str, breaks: bool = True) -> DataFrame:
    """Items from a CSV: reserved columns are lifted out, a missing id is the row's place."""
    return lifted(positioned(read_table(spark, path, breaks), "__pos"), F.col("__pos"), ("__pos",))


def folder_items(spark: SparkSession, path: str, breaks: bool = True) -> DataFrame:
    """Items of all CSV pools of a folder, with ``file_name``; a missing id is the row's place in its own file.

    The files must have one header; where they don't, reading them fails.
    """
    rows = read_folder(spark, path, breaks, enforceSchema=False)
    return lifted(positioned(rows, "__pos", within="__at"), F.col("__at.place"), ("__pos", "__at", "file_name"), "file_name")


def lifted(rows: DataFrame, place: Column, others: tuple[str, ...], *kept: str) -> DataFrame:
    """Rows as items; ``others`` are columns that are no fields, of which ``kept`` stay."""
    has = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit("")) if c in rows.columns else F.lit("")
    fields = [c for c in rows.columns if c not in (*RESERVED, *others)]
    given = F.when(has("weight") == "", F.lit(None)).otherwise(has("weight")) if "weight" in rows.columns else F.lit("1.0")
    return rows.select(
        F.coalesce(F.nullif(has("id"), F.lit("")), place.cast("string")).alias("id"),
        F.to_json(F.struct(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in fields])).alias("fields_json"),
        has("group").alias("group"),
        has("stratum").alias("stratum"),
        given.try_cast("double").alias("weight"),
        *kept,
    )


def jsonl_items(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """Items from JSON lines; blank lines are skipped, others keep what could be read of them.

    ``numbered`` adds ``line`` (from 1), by which problems name a line that has no identifier.
    """
    lines = spark.read.text(path)
    if numbered:
        lines = positioned(lines, "line").withColumn("line", F.col("line") + 1)
    return json_items(lines.where(~blank(F.col("value"))), F.col("value"), *(["line"] if numbered else []))


def blank(line: Column) -> Column:
    return ~line.rlike(r"(?U)\S")


def json_items(lines: DataFrame, value: Column, *others: str) -> DataFrame:
    """Items from JSON texts; of one that isn't JSON as a whole nothing is read."""
    lines = lines.withColumn("__json", whole_json(value))
    value = F.col("__json")
    get = lambda k: F.get_json_object(value, f"$.{k}")
    named = F.array_contains(F.json_object_keys(value), "weight")
    return lines.select(
        get("id").alias("id"),
        get("fields").alias("fields_json"),
        F.coalesce(get("group"), F.lit("")).alias("group"),
        F.coalesce(get("stratum"), F.lit("")).alias("stratum"),
        F.when(named, get("weight").try_cast("double")).otherwise(F.lit(1.0)).alias("weight"),
        *others,
    )


def problems(items: DataFrame, columns: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(problem, rows, example) of everything that refuses the pool, in one pass and one count by id."""
    keys = F.json_object_keys("fields_json")
    absent = F.array_except(F.array(*[F.lit(c) for c in columns]), keys) if columns else F.array().cast("array<string>")
    flags = {
        "id is empty": F.col("id").isNull() | (F.col("id") == ""),
        "fields is no object": keys.isNull(),
        "weight is no number": F.col("weight").isNull(),
        "a placeholder's column is missing": F.size(absent) > 0,
    }
    named = F.coalesce(F.nullif(F.col("id"), F.lit("")), F.format_string("line %d", "line") if "line" in items.columns else F.col("id")).alias("id")
    flagged = items.select(named, F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))).alias("problem"))
    twice = items.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("id is repeated").alias("problem"))
    return flagged.union(twice).groupBy("problem").agg(F.count("*").alias("rows"), F.min("id").alias("example"))


def validated(items: DataFrame, columns: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The items, once they are known to be sound; an empty pool is refused as well."""
    found = problems(items, columns).orderBy("problem").collect()
    if found:
        raise ItemsError("; ".join(f"{r.problem}: {r.rows} rows, such as {r.example!r}" for r in found))
    if items.isEmpty():
        raise ItemsError("the pool has no items")
    return items


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The usable lines of a result log with ``seq``, and their counts; see ``usable``."""
    return usable(positioned(spark.read.text(path), "seq"))


def usable(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of a log's lines (``value``) those that are records, with ``key``, and one row (lines, unreadable_lines).

    A line is a record if it is one JSON object with a key; torn and glued lines are counted as
    unreadable, blank ones not at all. Of a name given twice the last value counts.
    """
    lines = lines.where(~blank(F.col("value")))
    lines = lines.withColumn("key", F.from_json(whole_json(F.col("value")), "key string")["key"])
    counts = lines.agg(F.count("key").alias("lines"), F.count_if(F.col("key").isNull()).alias("unreadable_lines"))
    return lines.where("key is not null"), counts


def opened(path: str):
    """A stream of a file that Spark has listed."""
    if path.startswith("file:"):
        return LocalFileSystem().open_input_stream("/" + path[len("file:") :].lstrip("/"))
    files, name = FileSystem.from_uri(quote(path, safe="/:@%"))
    return files.open_input_stream(name)


def hashed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, sha256, lines) of every file, from its bytes; a file of any size is read CHUNK bytes at a time.

    Files are dealt over tasks one by one; the bytes of one are hashed in their order by one task.
    """
    # The scan would pass over empty files, but the driver has listed them all.
    listed = spark.read.format("binaryFile").load(path).inputFiles()
    files = spark.createDataFrame([(unquote(p),) for p in listed], "path string")
    names = "file_name string, sha256 string, lines long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                sha, lines = hashlib.sha256(), 0
                with opened(place) as f:
                    while data := f.read(CHUNK):
                        sha.update(data)
                        lines += data.count(b"\n")
                yield pa.RecordBatch.from_arrays([pa.array([place.rpartition("/")[2]]), pa.array([sha.hexdigest()]), pa.array([lines], pa.int64())], ["file_name", "sha256", "lines"])

    return files.repartition(4 * spark.sparkContext.defaultParallelism, "path").mapInArrow(run, names)
