"""Summaries of a result log: counts, weighted rates, crosstabs, latencies, agreement.

All are small aggregates over the latest records; counts combine before each shuffle. Verdicts
such as 0 or false are values like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import remove, scratch


def group_name() -> Column:
    return F.coalesce(F.nullif(F.col("group"), F.lit("")), F.lit("all"))


def weight() -> Column:
    """A weight of 0 or none counts as 1."""
    return F.coalesce(F.nullif(F.col("weight"), F.lit(0.0)), F.lit(1.0))


def totals(results: DataFrame) -> DataFrame:
    """One row of counts over all records."""
    return results.agg(
        F.count("*").alias("rows"),
        F.count_if(F.coalesce(F.col("parse_error"), F.lit("")) != "").alias("parse_errors"),
        F.count_if(F.col("error.class").isNotNull()).alias("errors"),
        F.count_if(F.coalesce(F.col("key_order_ok") == False, F.lit(False))).alias("key_order_violations"),  # noqa: E712
        F.count_if(F.coalesce(F.col("reasoning"), F.lit("")) != "").alias("replies_with_reasoning"),
        F.count_if(F.coalesce(F.col("error.class") == "length", F.lit(False))).alias("truncated"),
    )


def histogram(rows: DataFrame, value: Column, to: str) -> DataFrame:
    """Counts of the values that aren't null."""
    return rows.select(value.alias(to)).where(F.col(to).isNotNull()).groupBy(to).agg(F.count("*").alias("rows"))


def by_group(results: DataFrame) -> DataFrame:
    judged = F.count_if(F.col("answer_json").isNotNull())
    return results.groupBy(group_name().alias("group")).agg(F.count("*").alias("rows"), judged.alias("judged"), (F.count("*") - judged).alias("not_judged"))


def verdicts(results: DataFrame) -> DataFrame:
    return results.where("verdict is not null").groupBy(group_name().alias("group"), "verdict").agg(F.count("*").alias("rows"))


def rates(results: DataFrame, values: list[str]) -> DataFrame:
    """(group, verdict, rows, judged, rate, rate_weighted) for every allowed value, hit or not."""
    spark = results.sparkSession
    judged = F.col("answer_json").isNotNull()
    sums = results.where(judged).groupBy(group_name().alias("group"), "verdict").agg(F.count("*").alias("n"), F.sum(weight()).alias("w"))
    whole = sums.groupBy("group").agg(F.sum("n").alias("judged"), F.sum("w").alias("weight"))
    groups = results.select(group_name().alias("group")).distinct().join(whole, "group", "left")
    cells = groups.crossJoin(F.broadcast(spark.createDataFrame([(v,) for v in values], "verdict string")))
    cells = cells.join(sums, ["group", "verdict"], "left")
    n, w = F.coalesce("n", F.lit(0)), F.coalesce("w", F.lit(0.0))
    total = F.coalesce("judged", F.lit(0)).cast("long")
    return cells.select(
        "group", "verdict", n.cast("long").alias("rows"), total.alias("judged"),
        F.round(n / F.greatest(F.lit(1), total), 4).alias("rate"),
        F.round(w / F.coalesce(F.nullif(F.col("weight"), F.lit(0.0)), F.lit(1.0)), 4).alias("rate_weighted"),
    )


def crosstab(results: DataFrame) -> DataFrame:
    """(group, stratum, verdict, rows): each stratum, each group and the whole, in one pass."""
    rows = results.select(group_name().alias("group"), "stratum", F.coalesce("verdict", F.lit("not_judged")).alias("verdict"))
    sets = [["verdict"], ["group", "verdict"], ["group", "stratum", "verdict"]]
    return rows.groupingSets([[F.col(c) for c in s] for s in sets], "group", "stratum", "verdict").agg(F.count("*").alias("rows"))


def by_endpoint(results: DataFrame, by: tuple[str, ...] = ("endpoint",)) -> DataFrame:
    """Rows, models, exact nearest-rank quantiles and cut-off replies of each endpoint."""
    base = results.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.array_sort(F.collect_set("model")).alias("models"),
        F.max("latency_s").alias("latency_s_max"),
        F.max("completion_tokens").alias("completion_tokens_max"),
        F.count_if(F.coalesce(F.col("error.class") == "length", F.lit(False))).alias("truncated"),
    )
    return base.join(quantiles(results, by, {"latency_s": (50, 90), "completion_tokens": (50,), "prompt_tokens": (50,)}), list(by), "left")


#: Ranges into which the values that may hold a quantile are cut at a time.
RANGES = 4096


def quantiles(rows: DataFrame, by: tuple[str, ...], of: dict[str, tuple[int, ...]]) -> DataFrame:
    """Exact quantiles at half-even round(p * (n - 1)) as ``column_p50`` and so on, one row a group.

    By selection over ranges: each round counts the values of every group and quantile in ``RANGES`` ranges between
    the least and the greatest that are left, and goes on with the range that holds the rank, until
    it holds one value. Counts combine before the shuffle, so whatever its rows and distinct values, a group
    is never ordered by a task: a window sees RANGES rows. Rounds end by themselves: each makes what is left narrower
    by that factor. Nulls don't count; NaN is above all numbers; whole numbers from 2**53 on are compared as doubles.
    """
    spark, kinds = rows.sparkSession, dict(rows.dtypes)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(p).alias("p"), F.col(f"`{c}`").cast("double").alias("v")) for c, ps in of.items() for p in ps]))
    values = rows.select(*by, each.alias("x")).select(*by, "x.*").where("v is not null")
    keys, finite = [*by, "column", "p"], F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v"))
    left = values.groupBy(*keys).agg(F.count("*").alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi"))
    left = left.select(*keys, F.bround(F.col("p") / 100 * (F.col("n") - 1), 0).cast("long").alias("rank"), "lo", "hi", F.lit(False).alias("done"))
    below, above = F.col("v") == float("-inf"), F.isnan("v") | (F.col("v") == float("inf"))
    width = F.col("hi") / RANGES - F.col("lo") / RANGES
    inside = F.when(width > 0, F.greatest(F.lit(0.0), F.least(F.lit(RANGES - 1.0), F.floor(F.col("v") / width - F.col("lo") / width)))).otherwise((F.col("v") > F.col("lo")).cast("double"))
    place = F.when(below, -1).when(F.isnan("v"), RANGES + 1).when(above, RANGES).otherwise(inside).cast("int")
    kept = F.col("lo").isNull() | F.col("v").between(F.col("lo"), F.col("hi")) | ~F.col("v").between(F.lit(-1.7976931348623157e308), F.lit(1.7976931348623157e308))
    ended, first = [], True
    while True:
        path = scratch(spark, "quantiles")
        left.write.parquet(path)
        left = spark.read.schema(left.schema).parquet(path)
        ended.append(left.where("done"))
        todo = left.where("not done")
        if todo.isEmpty():
            break
        # In the first round infinities are counted as well; afterwards they are below or above what is left.
        counted = values.join(todo, keys).where(kept if first else F.col("v").between(F.col("lo"), F.col("hi")) | F.isnan("v") & F.isnan("lo"))
        counted = counted.withColumn("place", place).groupBy(*keys, "rank", "place").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
        hit = counted.withColumn("upto", upto).where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        left = hit.select(*keys, (F.col("rank") - (F.col("upto") - F.col("n"))).alias("rank"), "lo", "hi", (F.col("lo") == F.col("hi")).alias("done"))
        first = False
    found = reduce(DataFrame.unionByName, ended)
    at = lambda c, p: F.max(F.when((F.col("column") == c) & (F.col("p") == p), F.col("lo"))).cast(kinds[c]).alias(f"{c}_p{p}")
    return found.groupBy(*by).agg(*[at(c, p) for c, ps in of.items() for p in ps])


def counted_quantiles(rows: DataFrame, by: tuple[str, ...], column: str, ps: tuple[int, ...]) -> DataFrame:
    return quantiles(rows, by, {column: ps})


def endpoint_errors(results: DataFrame) -> DataFrame:
    """(endpoint, class, rows) of the records that are errors."""
    return results.where("error.class is not null").groupBy("endpoint", F.col("error.class").alias("class")).agg(F.count("*").alias("rows"))


def pairs(results: DataFrame) -> DataFrame:
    """(id, a, b, va, vb): the verdicts of two endpoints on one item, a before b."""
    rows = results.where("verdict is not null").select("id", "endpoint", "verdict")
    left = rows.select("id", F.col("endpoint").alias("a"), F.col("verdict").alias("va"))
    right = rows.select("id", F.col("endpoint").alias("b"), F.col("verdict").alias("vb"))
    return left.join(right, "id").where("a < b")


def agreement(results: DataFrame) -> DataFrame:
    return pairs(results).groupBy("a", "b").agg(F.count("*").alias("rows"), F.count_if(F.col("va") == F.col("vb")).alias("agree"))


def confusion(results: DataFrame) -> DataFrame:
    return pairs(results).groupBy("a", "b", F.concat_ws("|", "va", "vb").alias("verdicts")).agg(F.count("*").alias("rows"))


def label_domain(results: DataFrame) -> DataFrame:
    """The labels seen, for contracts that name none."""
    return results.agg(F.array_sort(F.collect_set("verdict")).alias("values"))


def join_back(rows: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    """Source rows with their verdicts, null where there is none."""
    return rows.join(results.select(key, "verdict", "short_reason"), key, "left")


#: The levels of ``cube``: what its rows are grouped by.
LEVELS = {
    "total": (), "class": ("class",), "note": ("note",), "group": ("group",), "verdict": ("group", "verdict"), "stratum": ("group", "stratum", "verdict"),
    "endpoint": ("endpoint",), "endpoint_class": ("endpoint", "class"), "model": ("endpoint", "model"),
}


def cube(results: DataFrame) -> DataFrame:
    """Counts, weights and maxima of every level at once: (level, group, stratum, verdict, class, note, endpoint, model, ...).

    One scan and one shuffle: each record is expanded to the levels, and combined before the shuffle.
    """
    names = ("group", "stratum", "verdict", "class", "note", "endpoint", "model")
    judged = F.col("answer_json").isNotNull()
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    rows = results.select(
        group_name().alias("group"), "stratum", "verdict", F.col("error.class").alias("class"), F.col("parse_note").alias("note"), "endpoint", "model", "latency_s", "completion_tokens",
        flag(F.coalesce(F.col("parse_error"), F.lit("")) != "").alias("parse_errors"), flag(F.col("error.class").isNotNull()).alias("errors"), flag(F.col("key_order_ok") == False).alias("key_order_violations"),  # noqa: E712
        flag(F.coalesce(F.col("reasoning"), F.lit("")) != "").alias("replies_with_reasoning"), flag(F.col("error.class") == "length").alias("truncated"), flag(judged).alias("judged"), F.when(judged, weight()).otherwise(0.0).alias("weight"),
    )
    sums = ("parse_errors", "errors", "key_order_violations", "replies_with_reasoning", "truncated", "judged", "weight")
    bits = F.grouping_id()
    wide = rows.groupingSets([[F.col(c) for c in cs] for cs in LEVELS.values()], *names).agg(
        bits.alias("__bits"), F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in sums], F.max("latency_s").alias("latency_s_max"), F.max("completion_tokens").alias("completion_tokens_max")
    )
    # A bit is set where the column isn't one of the level's.
    number = lambda cs: sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in cs)
    level = F.create_map(*[F.lit(x) for n, cs in LEVELS.items() for x in (number(cs), n)])[F.col("__bits").cast("int")]
    return wide.select(level.alias("level"), *names, "rows", *sums, "latency_s_max", "completion_tokens_max")


#: The columns of records that ``document`` reads.
SUMMED = ("id", "group", "stratum", "weight", "endpoint", "model", "answer_json", "verdict", "reasoning", "parse_note", "key_order_ok", "parse_error", "error", "latency_s", "prompt_tokens", "completion_tokens")
#: Texts of which it only matters whether they are null or empty.
MARKS = ("answer_json", "reasoning", "parse_error")


def document(results: DataFrame, values: list[str], planned: int | None = None) -> dict:
    """The whole summary as one nested document: counts, rates and histograms from one scan; quantiles and agreement beside it.

    ``results`` are worked out once: what is read of them, without long texts, is written aside for all scans.
    """
    spark, place = results.sparkSession, scratch(results.sparkSession, "summed")
    narrow = results.select(*[F.substring(c, 1, 1).alias(c) if c in MARKS else F.col(f"`{c}`") for c in SUMMED])
    narrow.write.parquet(place)
    found = of_summed(spark.read.schema(narrow.schema).parquet(place), values, planned)
    remove(spark, place)
    return found


def of_summed(results: DataFrame, values: list[str], planned: int | None) -> dict:
    level: dict[str, list] = {name: [] for name in LEVELS}
    for r in cube(results).orderBy("group", "stratum", "verdict", "class", "note", "endpoint", "model").collect():  # a row a group, stratum and verdict at most
        level[r.level].append(r)
    total = level["total"][0] if level["total"] else None
    count = lambda name: (total[name] or 0) if total else 0
    out = {c: count(c) for c in ("rows", "parse_errors", "errors", "key_order_violations", "replies_with_reasoning", "truncated")} | {"label_values": values}
    out["errors_by_class"] = {r["class"]: r.rows for r in level["class"] if r["class"] is not None}
    out["parse_notes"] = {r.note: r.rows for r in level["note"] if r.note is not None}
    groups = {r.group: {"group": r.group, "rows": r.rows, "judged": r.judged, "not_judged": r.rows - r.judged} for r in level["group"]}
    whole = {r.group: (r.judged, r.weight) for r in level["group"]}
    hits = {(r.group, r.verdict): (r.judged, r.weight) for r in level["verdict"]}
    for g, found in groups.items():
        (judged, w) = whole[g]
        for v in values:
            n, part = hits.get((g, v), (0, 0.0))
            found.setdefault("rates", {})[v] = round(n / max(1, judged), 4)
            found.setdefault("rates_weighted", {})[v] = round(part / (w or 1.0), 4)
    for r in level["stratum"]:
        groups[r.group].setdefault("by_stratum", {}).setdefault(r.stratum, {})[r.verdict or "not_judged"] = r.rows
    out["by_group"] = groups
    for r in level["endpoint_class"]:
        if r["class"] is not None:
            out.setdefault("errors_by_endpoint", {}).setdefault(r.endpoint, {})[r["class"]] = r.rows
    ends = {r.endpoint: {k: r[k] for k in ("endpoint", "rows", "latency_s_max", "completion_tokens_max", "truncated")} | {"models": []} for r in level["endpoint"]}
    for r in level["model"]:
        ends[r.endpoint]["models"] += [r.model] if r.model is not None else []
    for r in quantiles(results, ("endpoint",), {"latency_s": (50, 90), "completion_tokens": (50,), "prompt_tokens": (50,)}).collect():
        ends[r.endpoint] |= r.asDict()
    out["by_endpoint"] = ends
    # Records of one endpoint agree with no other's, and needn't be paired.
    out["agreement"] = [r.asDict() for r in agreement(results).orderBy("a", "b").collect()] if len(ends) > 1 else []
    if planned is not None:
        out |= {"planned": planned, "missing": planned - out["rows"]}
    return out
