"""Stratified, weighted sampling of tables into pools of items."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import seeded
from ..functions.template import label
from ..sources.config import ConfigError, Group, Spec
from ..sources.items import positioned, read_table


def selection(select: dict[str, tuple[str, ...]], columns: list[str], of: str = "") -> Column:
    """All conditions of a group; a column outside ``columns`` is refused."""
    if unknown := [c for c in select if c not in columns]:
        raise ConfigError(f"select names unknown columns: {', '.join(unknown[:8])}")
    name = (lambda c: F.col(f"{of}.`{c}`")) if of else (lambda c: F.col(f"`{c}`"))
    tests = [name(c) == v[0] if len(v) == 1 else name(c).isin(*v) for c, v in select.items()]
    return reduce(and_, tests, F.lit(True))


def zipped(rows: DataFrame, attrs: DataFrame | None, by_file: bool | None = None) -> DataFrame:
    """(pos, row, attr): rows and attributes by position; both must have the same places.

    ``by_file`` matches files in order of their paths and rows within them, so that files of unlike
    lengths show as rows without a counterpart; otherwise rows are matched by their places in all
    files. Unless it is said, files are matched where both sides have as many.
    """
    both = lambda df, name: df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
    if attrs is None:
        return positioned(both(rows, "row")).withColumn("attr", F.col("row"))
    left, right = positioned(both(rows, "row"), within="at"), positioned(both(attrs, "attr"), within="at")
    files = lambda df: df.agg(F.max("at.file")).first()[0]
    by_file = files(left) == files(right) if by_file is None else by_file
    side = lambda df, mark: df.select("*", F.lit(1).alias(mark), *([F.col("at.file").alias("file"), F.col("at.place").alias("place")] if by_file else []))
    if not by_file:
        return side(left.drop("at"), "in_rows").join(side(right.drop("at"), "in_attrs"), "pos", "full_outer")
    pairs = side(left, "in_rows").join(side(right, "in_attrs").withColumnRenamed("pos", "attr_pos"), ["file", "place"], "full_outer")
    return pairs.select(F.coalesce("pos", "attr_pos").alias("pos"), "row", "in_rows", "attr", "in_attrs")


def mismatches(joined: DataFrame) -> DataFrame:
    """(pos, problem) of rows without their counterpart, or whose index isn't their place."""
    sided = "in_rows" in joined.columns
    lone = (F.col("in_rows").isNull() | F.col("in_attrs").isNull()) if sided else F.lit(False)
    names = joined.schema["attr"].dataType.names
    moved = ~F.coalesce(F.col("attr.index").cast("string") == F.col("pos").cast("string"), F.lit(False)) if "index" in names else F.lit(False)
    return joined.select("pos", F.when(lone, "no counterpart").when(moved, "index differs").alias("problem")).where("problem is not null")


def stratum_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("group", "stratum").agg(F.count("*").alias("eligible"))


def allocate(counts: DataFrame, size: Column, alloc: Column) -> DataFrame:
    """Adds ``take`` to (group, stratum, eligible), for a group's size and kind of allocation.

    Proportional: floors of the exact shares, the rest to the largest remainders (then by name).
    Equal: the highest level that all strata can share, the rest by name to strata that have more.
    A size of 0 or less, or of at least all rows, takes all. It works on counts alone.
    """
    group = Window.partitionBy("group")
    rows = counts.withColumn("size", size.cast("long")).withColumn("alloc", alloc).withColumn("total", F.sum("eligible").over(group))
    share = F.col("size") * F.col("eligible")
    rows = rows.withColumn("floor", F.floor(share / F.col("total"))).withColumn("rest", share % F.col("total"))
    rows = rows.withColumn("by_rest", F.row_number().over(group.orderBy(F.desc("rest"), "stratum")))
    smaller = group.orderBy("eligible", "stratum").rowsBetween(Window.unboundedPreceding, -1)
    before, rank = F.coalesce(F.sum("eligible").over(smaller), F.lit(0)), F.coalesce(F.count("*").over(smaller), F.lit(0))
    rows = rows.withColumn("level", F.floor((F.col("size") - before) / (F.count("*").over(group) - rank)))
    rows = rows.withColumn("level", F.max("level").over(group)).withColumn("base", F.least("eligible", "level"))
    rows = rows.withColumn("more", F.col("eligible") > F.col("level"))
    rows = rows.withColumn("by_name", F.row_number().over(Window.partitionBy("group", "more").orderBy("stratum")))
    proportional = F.col("floor") + (F.col("by_rest") <= F.col("size") - F.sum("floor").over(group)).cast("long")
    equal = F.col("base") + (F.col("more") & (F.col("by_name") <= F.col("size") - F.sum("base").over(group))).cast("long")
    take = F.when((F.col("size") <= 0) | (F.col("size") >= F.col("total")), F.col("eligible")).when(F.col("alloc") == "equal", equal).otherwise(proportional)
    return rows.select("group", "stratum", "eligible", take.cast("long").alias("take"))


def draw(rows: DataFrame, allocated: DataFrame, seed: int = 42) -> DataFrame:
    """The rows drawn, with their weight: per stratum the first by a seeded hash of (group, stratum, pos)."""
    stratum = Window.partitionBy("group", "stratum").orderBy("__order", "pos")
    # One row for each stratum: the optimizer chooses how to join it.
    ranked = rows.withColumn("__order", seeded(seed, F.col("group"), F.col("stratum"), F.col("pos"))).withColumn("__rank", F.row_number().over(stratum))
    weight = F.round(F.col("eligible") / F.col("take"), 6).alias("weight")
    drawn = ranked.join(allocated, ["group", "stratum"]).where(F.col("__rank") <= F.col("take"))
    return drawn.select(*rows.columns, weight)


def group_rows(joined: DataFrame, group: Group) -> DataFrame:
    """(pos, row, group, stratum) of the rows that a group selects: by attributes only."""
    attrs = joined.schema["attr"].dataType.names
    both = {c: F.col(f"row.`{c}`") for c in joined.schema["row"].dataType.names} | {c: F.col(f"attr.`{c}`") for c in attrs}
    chosen = joined.where(selection(group.select, attrs, "attr"))
    return chosen.select("pos", "row", F.lit(group.name).alias("group"), label(group.stratum, both).alias("stratum"))


def make_items(spark: SparkSession, spec: Spec, sizes: dict[str, int], seed: int = 42, tables: dict[str, tuple[DataFrame, DataFrame | None]] | None = None) -> DataFrame:
    """The pool of a spec: id ``table:position``, fields, group, stratum, weight, ordered by id.

    ``tables`` may give (rows, attrs) directly; otherwise the spec's CSV paths are read.
    """
    parts = []
    for name, paths in spec.tables.items():
        groups = [g for g in spec.groups if g.table == name and g.name in sizes]
        if not groups:
            continue
        rows, attrs = tables[name] if tables else (read_table(spark, paths["rows"]), read_table(spark, paths["attrs"]) if "attrs" in paths else None)
        joined = zipped(rows, attrs)
        if bad := mismatches(joined).orderBy("pos").head(1):
            raise ConfigError(f"table {name}: row {bad[0].pos}: {bad[0].problem}")
        eligible = reduce(DataFrame.unionByName, [group_rows(joined, g) for g in groups])
        size = F.create_map(*[F.lit(x) for g in groups for x in (g.name, sizes[g.name])])[F.col("group")]
        kind = F.create_map(*[F.lit(x) for g in groups for x in (g.name, g.alloc)])[F.col("group")]
        drawn = draw(eligible, allocate(stratum_counts(eligible), size, kind), seed)
        fields = F.struct(*[F.col(f"row.`{c}`").alias(c) for c in rows.columns if c != "index"])
        parts.append(drawn.select(F.concat(F.lit(f"{name}:"), F.col("pos")).alias("id"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("fields_json"), "group", "stratum", "weight"))
    if not parts:
        raise ConfigError("no group has a size")
    items = reduce(DataFrame.unionByName, parts)
    if twice := items.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").orderBy("id").head(1):
        raise ConfigError(f"the row {twice[0].id} was drawn by two groups")
    return items.orderBy("id")
