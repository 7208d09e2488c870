"""Token counts of documents in flat, unindexed token files.

A token file is nothing but ids of ``width`` bytes, little-endian; an end-of-document id follows
each document. No index says where documents begin. Files are cut into blocks by byte ranges;
each task searches its block for the separator with one vectorised comparison and reports the
document ends that it saw; a prefix scan over the blocks of each file carries the last separator
and the number of documents across block boundaries.

Edge cases: an empty file has no documents; two separators in a row enclose an empty document; ids
after the last separator are a document of their own, marked ``ended`` false; a document may span
any number of blocks. On writing, null texts are empty, rows that share an identifier are documents of
their own, an empty table gives files without documents, and a text whose ids hold the separator is
refused, so an encoder must take the separator's string as ordinary text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import file_system, put_file, scratch, sliced, written

#: Ids in one block of the scan.
BLOCK_IDS = 4_000_000


def write_flat(df: DataFrame, encode: Callable[[], Callable[[list[str]], list[bytes]]], end_id: int, folder: str | None = None, key: str = "doc_id", text: str = "text", width: int = 2) -> str:
    """Writes the ids of all texts, one flat file for each task, in the tasks' own order.

    Returns the folder, which also holds ``order``, a Parquet table (file, ordinal, key) that says
    which document is which in its file; the counts don't need it.
    """
    folder = folder or scratch(df.sparkSession, "flat")
    key_type = df.schema[key].dataType
    kind = np.dtype("<u2" if width == 2 else "<u4")

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/tokens-{TaskContext.get().partitionId():06d}.bin"
        encoder, keys = encode(), []
        ending = np.array([end_id], kind).tobytes()

        def stream(out) -> None:
            for batch in sliced(of):
                for ids in encoder([x or "" for x in batch.column(1).to_pylist()]):
                    wide = np.frombuffer(ids, "<u4")
                    if len(wide) and (wide.max() > np.iinfo(kind).max or (wide == end_id).any()):
                        raise ValueError("an id doesn't fit the file, or is the separator")
                    out.write(wide.astype(kind).tobytes() + ending)
                keys.append(batch.column(0))

        put_file(path, stream)
        ordinal = 0
        for column in keys:
            n = len(column)
            yield pa.RecordBatch.from_arrays([pa.array([path.rpartition("/")[2]] * n), pa.array(range(ordinal, ordinal + n), pa.int64()), column], ["file", "ordinal", "key"])
            ordinal += n

    df.select(key, text).mapInArrow(run, f"file string, ordinal long, key {key_type.simpleString()}").write.parquet(f"{folder}/order")
    return folder


def scan_blocks(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """(file, block, n_ids, ends): the positions in each file of the separators in each block."""
    kind = np.dtype("<u2" if width == 2 else "<u4")
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n_ids", pa.int64()), ("ends", pa.list_(pa.int64()))])

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in of:
            for path, block, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                files, name = file_system(path)
                with files.open_input_file(name) as f:
                    ids = np.frombuffer(f.read_at(length * width, start * width), kind)
                ends = np.flatnonzero(ids == end_id) + start
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], schema=schema)

    return blocks.mapInArrow(run, "file string, block long, n_ids long, ends array<long>")


def token_counts(spark: SparkSession, folder: str, end_id: int, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document in a folder of flat files.

    ``file`` is the name within the folder.

    ``start`` counts ids from the file's beginning; ``n_tokens`` leaves the separator out.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.bin").load(folder).select(F.regexp_replace("path", "^file:/+", "file:///").alias("file"), (F.col("length") / width).cast("long").alias("ids"))
    blocks = files.filter("ids > 0").select("file", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("ids") - 1, F.lit(block_ids).cast("long"))).alias("block", "start"), "ids").select("file", F.col("block").cast("long").alias("block"), "start", F.least(F.lit(block_ids), F.col("ids") - F.col("start")).cast("long").alias("length"))
    blocks = blocks.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file", "block")
    found = written(scan_blocks(blocks, end_id, width), "ends")
    # The scan carries two numbers from block to block, one small row each; the ends stay with their blocks.
    seen = found.select("file", "block", F.try_element_at("ends", F.lit(-1)).alias("last"), F.size("ends").alias("n"))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    carry = seen.select("file", "block", F.coalesce(F.max("last").over(before), F.lit(-1)).cast("long").alias("previous"), F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("done"), F.lead("block").over(order).isNull().alias("is_last"))
    carried = found.withColumn("size", F.col("block") * block_ids + F.col("n_ids")).join(carry, ["file", "block"])
    rows = carried.select("file", "done", F.posexplode(F.arrays_zip(F.concat(F.array("previous"), F.expr("slice(ends, 1, greatest(size(ends) - 1, 0))")).alias("a"), F.col("ends").alias("b"))).alias("i", "doc")).where("doc.b is not null")
    whole = rows.select("file", (F.col("done") + F.col("i")).alias("ordinal"), (F.col("doc.a") + 1).alias("start"), (F.col("doc.b") - F.col("doc.a") - 1).alias("n_tokens"), F.lit(True).alias("ended"))
    at_end = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("previous"))
    rest = carried.where("is_last").select("file", (F.col("done") + F.size("ends")).alias("ordinal"), (at_end + 1).alias("start"), (F.col("size") - at_end - 1).alias("n_tokens"), F.lit(False).alias("ended")).where("n_tokens > 0")
    counted = whole.unionByName(rest)
    return counted.withColumn("file", F.element_at(F.split("file", "/"), -1))
