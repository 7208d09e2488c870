"""Filter interaction audit: what every order of filters removes, from counts of joint failures.

For each part, and for each set S of filters, one aggregation sums the product of the flags of S: how
many documents fail all of S, how many of these are good, and how many toxic. All else follows:

* ``survivors`` of a set P are the sum over its subsets S of (-1)**|S| joint(S), the Moebius inverse;
  a step removes the survivors before it less those after it;
* ``unique_fails`` of a filter is the Moebius inverse at {filter}: documents that fail it alone;
* ``redundant`` is joint({filter}) less what the step removes;
* the set game "documents that S removes" has the Harsanyi dividends (-1)**(|S| + 1) joint(S), and a
  filter's Shapley value is the sum of dividend / size over the sets it is in. Over all k! orders
  it is that times k!, a whole number.

Texts stay in the tasks that read them: what is shuffled is a digest, identifiers and flags. Copies are found by
digests of 256 bits, with counts combined before each shuffle, so a text of a third of all rows is a
row for each task. Only sums, one row a part, are expanded to orders and steps.

Edge cases: null texts count as empty, and fail A, and all but the first E (of empty texts; 0 of 0 words are
not under half); null parts are the part of the empty string; rows with a null identifier have no smaller
identifier, and are none to others, so they pass E, and they have no labels; rows that share the smallest
identifier of a text all pass E; of several labels of one identifier the highest of each kind counts; an empty table has no parts.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial
from operator import mul

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let

#: The filters of ``flagged``, by letter.
FILTERS = "ABCDE"
WORDS = r"[\x20\x09-\x0D]+"


def flagged(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, digest, A, B, C, D): the failures of each document alone, without its text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counts = let(F.array_remove(F.split(body, WORDS), ""), lambda w: F.struct(F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("distinct")))
    capitals = F.length(body) - F.length(F.regexp_replace(body, "[A-Z]", ""))
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(body, 256)).alias("digest"),
        counts.alias("n"), (F.lit(100).cast("long") * capitals > F.lit(3).cast("long") * F.length(body)).alias("C"), body.rlike(r"[#$%&*|]").alias("D"),
    )
    few, poor = F.col("n.words") < 200, F.lit(100).cast("long") * F.col("n.distinct") < F.lit(50).cast("long") * F.col("n.words")
    return rows.select("id", "part", "digest", few.alias("A"), poor.alias("B"), "C", "D")


def with_labels(rows: DataFrame, labels: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    """Adds a flag for each of ``names``, true where a label of the row's ``id`` is 1."""
    one = labels.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").cast("long").alias("id"))
    known = one.agg(*[F.max(F.coalesce(F.col(f"`{n}`") == 1, F.lit(False))).alias(n) for n in names])
    has = rows.where("id is not null").join(known, "id", "left").select(*rows.columns, *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in names])
    # Rows without an identifier need no join, in which they would share one key.
    return has.unionByName(rows.where("id is null").select("*", *[F.lit(False).alias(n) for n in names]))


def without_first(rows: DataFrame, measures: tuple[str, ...], to: str = "E") -> DataFrame:
    """Counts ``n`` of the rows of each (part, flags, measures), with the flag: a smaller ``id`` has this digest."""
    same = [c for c in rows.columns if c != "id"]
    by_id = rows.groupBy(*same, "id").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least")
    unknown = F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unknown")
    groups = by_id.groupBy(*same).agg(F.sum("n").alias("n"), unknown, least)
    # A digest has as many rows here as it has parts and labels.
    first = F.min("least.id").over(Window.partitionBy("digest"))
    passed = F.col("unknown") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(F.lit(0))
    groups = groups.withColumn("first", first).withColumn("passed", passed)
    flags = [c for c in same if c not in ("digest", *measures, "part")]
    split = F.explode(F.array(F.struct(F.lit(False).alias(to), F.col("passed").alias("n")), F.struct(F.lit(True).alias(to), (F.col("n") - F.col("passed")).alias("n"))))
    return groups.select("part", *flags, *measures, split.alias("s")).select("part", *flags, f"s.{to}", *measures, "s.n").where("n > 0")


def joint_failures(rows: DataFrame, filters: str, measures: tuple[str, ...] = ()) -> DataFrame:
    """(part, documents, *measures): for each set of filters, as a mask, how many rows fail all of it.

    ``rows`` has ``n`` equal rows in each; flags are products, so an empty set counts all rows.
    """
    flags = {f: F.col(f).cast("long") for f in filters}
    inside = lambda s: [flags[f] for i, f in enumerate(filters) if s >> i & 1]
    of = lambda m, s: F.sum(reduce(mul, [*([F.col(m).cast("long")] if m else []), *inside(s)], F.col("n")))
    sums = [of(m, s).alias(f"{m or 'documents'}_{s}") for m in (None, *measures) for s in range(1 << len(filters))]
    wide = rows.groupBy("part").agg(*sums)
    return wide.select("part", *[F.array(*[F.col(f"{m}_{s}") for s in range(1 << len(filters))]).alias(m) for m in ("documents", *measures)])


def inverted(joint: Column, base: int, rest: int) -> Column:
    """The rows that fail all of ``base`` and none of ``rest``: the Moebius inverse of joint failures."""
    parts, s = [], rest
    while True:
        sign = F.lit(1 - 2 * (s.bit_count() & 1)).cast("long")
        parts.append(sign * F.get(joint, F.lit(base | s)))
        if not s:
            return reduce(lambda a, b: a + b, parts)
        s = s - 1 & rest


def audited(joint: DataFrame, filters: str, measures: tuple[str, ...] = (), lost: str = "{}_lost") -> DataFrame:
    """One row for each part, order of the filters and step, from ``joint_failures``."""
    full, k = (1 << len(filters)) - 1, len(filters)
    every = range(full + 1)
    left = {m: F.array(*[inverted(F.col(m), 0, p) for p in every]).alias(f"left_{m}") for m in ("documents", *measures)}
    alone = F.array(*[inverted(F.col("documents"), 1 << i, full & ~(1 << i)) for i in range(k)]).alias("alone")
    # Harsanyi dividends of the sets, shared by their filters: (k! / size) is whole.
    dividend = lambda s: F.lit((1 if s.bit_count() & 1 else -1) * (factorial(k) // s.bit_count())).cast("long") * F.get("documents", F.lit(s))
    shapley = F.array(*[reduce(lambda a, b: a + b, [dividend(s) for s in every if s >> i & 1]) for i in range(k)]).alias("shapley")
    parts = joint.select("part", F.col("documents").alias("joint"), *left.values(), alone, shapley)
    orders = F.lit(["".join(p) for p in permutations(filters)])
    steps = parts.select("*", F.explode(orders).alias("filter_order")).select("*", F.posexplode(F.split("filter_order", "")).alias("place", "filter"))
    bits = F.lit([1 << i for i in range(k)])
    bit = lambda f: F.get(bits, F.instr(F.lit(filters), f) - 1)
    mask = F.aggregate(F.slice(F.split("filter_order", ""), 1, F.col("place")), F.lit(0), lambda m, f: m + bit(f))
    rows = steps.withColumn("i", F.instr(F.lit(filters), F.col("filter")) - 1).withColumn("before", mask).withColumn("after", F.col("before") + bit(F.col("filter")))
    gone = lambda m: F.get(f"left_{m}", F.col("before")) - F.get(f"left_{m}", F.col("after"))
    return rows.select(
        "part", "filter_order", (F.col("place") + 1).alias("step"), F.get("left_documents", F.col("after")).alias("kept"), gone("documents").alias("removed"),
        (F.get("joint", bit(F.col("filter"))) - gone("documents")).alias("redundant"), F.get("alone", F.col("i")).alias("unique_fails"),
        *[gone(m).alias(lost.format(m)) for m in measures], F.get("shapley", F.col("i")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The audit of the five filters over the documents of each part, with good and toxic ones lost; see the module."""
    marks = labels.select(F.col(f"`{key}`"), F.col("quality").alias("good"), F.col("toxic"))
    rows = with_labels(flagged(docs, key, text, part), marks, key, ("good", "toxic"))
    counted = without_first(rows, ("good", "toxic"))
    return audited(joint_failures(counted, FILTERS, ("good", "toxic")), FILTERS, ("good", "toxic"))
