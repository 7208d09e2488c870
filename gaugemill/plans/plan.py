"""Plans: which rows go to which endpoint, in which order, and which of them are still to be sent."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import row_key, seeded
from ..sources.config import ConfigError, Endpoint

#: Rows are numbered bucket by bucket of the hash, so that no task sorts them all.
BUCKET_DIGITS = 3


def numbered(rows: DataFrame, order: Column, tie: Column, to: str = "ord", by: tuple[str, ...] = ()) -> DataFrame:
    """Adds the 0-based place of each row (of each group ``by``) by a hexadecimal hash; counts by bucket give the offsets."""
    rows = rows.withColumn("__order", order).withColumn("__bucket", F.substring("__order", 1, BUCKET_DIGITS))
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 16 ** BUCKET_DIGITS rows a group
    starts = rows.groupBy(*by, "__bucket").agg(F.count("*").alias("n")).select(*by, "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy(*by, "__bucket").orderBy("__order", tie))
    # Of one group the counts are known to be few; of many the optimizer chooses how to join them.
    placed = rows.withColumn("__within", within).join(starts if by else F.broadcast(starts), [*by, "__bucket"])
    return placed.withColumn(to, (F.col("__start") + F.col("__within") - 1).cast("long")).drop("__order", "__bucket", "__start", "__within")


def send_order(items: DataFrame, seed: int = 42) -> DataFrame:
    """Adds ``ord``: a seeded order that any prefix of is a random sample."""
    return numbered(items, seeded(seed, "order", F.col("id")), F.col("id"))


def folder_order(items: DataFrame, limit: int, seed: int = 42) -> DataFrame:
    """The send order of each file (``file_name``) by itself, of which the first ``limit`` rows are left; 0 for all."""
    return limited(numbered(items, seeded(seed, "order", F.col("id")), F.col("id"), by=("file_name",)), limit)


def first_in_order(items: DataFrame, limit: int, seed: int = 42) -> DataFrame:
    """The first rows in send order, with ``ord``, without numbering the rest; 0 for all."""
    if limit < 0:
        raise ConfigError("limit must not be negative")
    if not limit:
        return send_order(items, seed)
    first = items.withColumn("__order", seeded(seed, "order", F.col("id"))).orderBy("__order", "id").limit(limit).drop("__order")
    return send_order(first, seed)


def limited(plan: DataFrame, limit: int) -> DataFrame:
    """The first rows in send order, 0 for all."""
    if limit < 0:
        raise ConfigError("limit must not be negative")
    return plan.where(F.col("ord") < limit) if limit else plan


def part_of(plan: DataFrame, part: str, total: Column | None = None) -> DataFrame:
    """Part ``k/n`` of the order: parts don't overlap, cover all rows and differ by a row at most."""
    m = re.fullmatch(r"(\d+)/(\d+)", part)
    k, n = (int(m[1]), int(m[2])) if m else (0, 0)
    if not 1 <= k <= n:
        raise ConfigError(f"part {part!r} is not k/n with 1 <= k <= n")
    rows = total if total is not None else F.lit(plan.count())
    return plan.where((F.col("ord") >= F.floor(rows * (k - 1) / n)) & (F.col("ord") < F.floor(rows * k / n)))


def endpoint_table(spark: SparkSession, endpoints: list[Endpoint]) -> DataFrame:
    return spark.createDataFrame([(e.name, e.model, e.concurrency) for e in endpoints], "endpoint string, model string, concurrency int")


def compare_plan(items: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Every row at every endpoint; endpoints are configured by name, one small row each."""
    return items.crossJoin(F.broadcast(endpoints.select("endpoint", "model")))


def shard_plan(items: DataFrame, endpoints: list[Endpoint]) -> DataFrame:
    """Every row at one endpoint, in proportion to concurrency; all must serve one model."""
    if len({e.model for e in endpoints}) != 1:
        raise ConfigError("endpoints that share the rows must serve one model")
    lanes = F.array(*[F.lit(e.name) for e in endpoints for _ in range(max(1, e.concurrency))])
    lane = F.pmod(F.xxhash64("id"), F.size(lanes)).cast("int")
    return items.withColumn("endpoint", F.get(lanes, lane)).withColumn("model", F.lit(endpoints[0].model))


def keyed(plan: DataFrame, prompt_sha: str, schema_sha: str | None, compare: bool = False) -> DataFrame:
    """Adds ``key``; where endpoints share the rows the key doesn't name one."""
    return plan.withColumn("key", row_key(F.col("id"), F.col("model"), prompt_sha, schema_sha, F.col("endpoint") if compare else F.lit("")))


def done_keys(results: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Keys that need no request: those of the latest records, without errors if these are retried.

    They are groups of ``key``, so that of a table that is bucketed by key none is shuffled, here or in ``remaining``.
    """
    if not retry_errors:
        return results.groupBy("key").agg(F.lit(True).alias("sound")).select("key")
    place = F.struct(F.col("seq"), F.xxhash64("error.class"))
    last = results.groupBy("key").agg(F.max_by(F.col("error.class").isNull(), place).alias("sound"))
    return last.where("sound").select("key")


def remaining(plan: DataFrame, done: DataFrame) -> DataFrame:
    return plan.join(done, "key", "left_anti")


def already_done(plan: DataFrame, done: DataFrame) -> DataFrame:
    return plan.join(done, "key", "left_semi")


def planned_missing(plan: DataFrame, done: DataFrame) -> DataFrame:
    """One row: how many rows are planned, and how many of them have no record."""
    marked = plan.select("key").join(done.select("key", F.lit(True).alias("has")).distinct(), "key", "left")
    return marked.agg(F.count("*").alias("planned"), F.count_if(F.col("has").isNull()).alias("missing"))


def planned_total(files: DataFrame, limit: int) -> DataFrame:
    """Rows that a limit for each file leaves, over (file_name, n)."""
    n = F.least("n", F.lit(limit)) if limit else F.col("n")
    return files.agg(F.sum(n).cast("long").alias("planned"))


def budget(rows: DataFrame, price: float, limit: int = 0, overhead: int = 2) -> DataFrame:
    """Requests and cost of a run over (file_name, n): each file sends its limit and a few of its own."""
    n = (F.least("n", F.lit(limit)) if limit else F.col("n")) + overhead
    return rows.agg(F.sum(n).cast("long").alias("requests"), F.round(F.sum(n) * price, 6).alias("cost"))
