"""Streams: live summaries, deduplicated appends; ``mirror`` has the mirror of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def missing_files(remote: DataFrame, local: DataFrame, key: str = "path") -> DataFrame:
    """What a restore has to copy: names that only the remote side has."""
    return remote.join(local.select(key), key, "left_anti")


def progress(events: DataFrame, by: list[str], ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Events in sliding windows of five minutes, every minute; works on streams and tables."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.window(ts, "5 minutes", "1 minute").alias("w"), *by).agg(F.count("*").alias("rows")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "rows")


def deduplicated(events: DataFrame, keys: list[str], ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Records with repeats of a key dropped, as far back as the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def summary_stream(spark: SparkSession, folder: str, schema: str, by: list[str], failed: Column, target: str, checkpoint: str) -> StreamingQuery:
    """A running count of records and failures, kept by Spark's state and written batch by batch."""
    rows = spark.readStream.schema(schema).parquet(folder)
    counts = rows.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(failed).alias("failed"))

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    return counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
