"""Operations on the append-only log that follow its order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def latest(results: DataFrame, key: str = "key", seq: str = "seq", columns: tuple[str, ...] = ()) -> DataFrame:
    """The last record of each key, by place in the log, with all its columns or those named; maxima combine before the shuffle.

    Of records that share a place, which no single log has, always the same one is taken, whatever the columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in columns or results.columns])
    place = F.struct(F.col(seq), F.xxhash64(*[F.col(f"`{c}`") for c, k in results.dtypes if "map<" not in k]))
    return results.groupBy(F.col(key).alias("__key")).agg(F.max_by(row, place).alias("row")).select("row.*")


def union_logs(*logs: DataFrame) -> DataFrame:
    """Logs one after another: later logs count as later records."""
    parts = [log.withColumn("seq", F.struct(F.lit(i).alias("log"), F.col("seq").alias("line"))) for i, log in enumerate(logs)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def without_copies(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.dropDuplicates(list(keys))


def streaks(events: DataFrame, by: list[str], order: list[str | Column], failed: Column) -> DataFrame:
    """Adds ``streak``: how many failures in a row end at this row, 0 at a success."""
    w = Window.partitionBy(*by).orderBy(*order)
    rows = events.withColumn("__failed", failed).withColumn("__island", F.sum((~F.col("__failed")).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = F.sum(F.col("__failed").cast("long")).over(Window.partitionBy(*by, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("streak", run).drop("__failed", "__island")


def first_all_failed(events: DataFrame, by: list[str], order: list[str | Column], failed: Column, n: int = 20) -> DataFrame:
    """Of each group: whether it has ``n`` rows and the first ``n`` all failed."""
    rows = events.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__rank") <= n)
    return rows.groupBy(*by).agg((F.count("*") == n).alias("full"), F.bool_and(failed).alias("all_failed")).select(*by, (F.col("full") & F.col("all_failed")).alias("refuse"))


def trailing(events: DataFrame, by: list[str], micros: Column, left: Column | None = None, spans: tuple[int, ...] = (60, 300)) -> DataFrame:
    """Adds the number of events in the last seconds of each row, and minutes left at that pace.

    Time is cut into slices of the longest span; each event also counts in the slice after its own, so
    that windows run within slices and a group's work is dealt over them.
    """
    wide = max(spans) * 1_000_000
    rows = events.withColumn("__micros", micros).withColumn("__own", F.floor(F.col("__micros") / wide))
    rows = rows.withColumn("__slice", F.explode(F.array("__own", F.col("__own") + 1)))
    for s in spans:
        rows = rows.withColumn(f"last_{s}s", F.count("*").over(Window.partitionBy(*by, "__slice").orderBy("__micros").rangeBetween(-s * 1_000_000, 0)))
    rows = rows.where(F.col("__slice") == F.col("__own"))
    if left is not None:
        rows = rows.withColumn("eta_minutes", F.round(left / (F.col(f"last_{spans[-1]}s") / (spans[-1] / 60)), 3))
    return rows.drop("__micros", "__own", "__slice")


def assembled(chunks: DataFrame, by: list[str], seq: str = "seq", delta: str = "delta", finish: str | None = "finish") -> DataFrame:
    """Streamed replies put together: deltas in order, and the last finish reason that isn't null."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(seq), F.coalesce(F.col(delta), F.lit("")))))
    text = F.array_join(F.transform(parts, lambda x: x["col2"]), "").alias("content")
    last = [F.max_by(F.col(finish), F.when(F.col(finish).isNotNull(), F.col(seq))).alias("finish_reason")] if finish else []
    return chunks.groupBy(*by).agg(text, *last)


def recent_events(events: DataFrame, by: list[str], order: str, value: str, n: int = 30) -> DataFrame:
    """The last ``n`` values of each group, oldest first; only ``n`` rows a group are gathered."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order), F.desc(value)))
    kept = events.withColumn("__rank", rank).where(F.col("__rank") <= n)
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return kept.groupBy(*by).agg(F.transform(listed, lambda x: x.v).alias("events"))
