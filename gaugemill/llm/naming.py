"""Exact deduplication by deterministic naming of blocks.

Texts are equal when they are identical after deleting the characters of ASCII white space.

1. Normalised texts are cut into blocks of ``BLOCK_BYTES`` bytes, and all distinct blocks of the table
   are sorted and named by their places. They are sorted by 128 bits of hash, once these are known
   to tell all blocks apart: of each hash the least and the greatest block, byte by byte, must be the
   same. Should two blocks ever share a hash, the hash with the next seed is taken. So names
   stand for bytes, though only one shuffle has carried the bytes of blocks.
2. In rounds, the names of neighbouring blocks make pairs (a last one alone pairs with -1), the
   distinct pairs are sorted and named by their places, and each document has half as many names,
   until each has one. By induction, a (round, name) stands for one text and for no other.

Least and greatest blocks combine before the shuffle, so that a block of a third of all rows is sent
once a task. Joins behind it carry a few numbers a row, and are plain joins of written tables, whose
skewed partitions Spark splits. Each round is a written table, a quarter of a percent of the text.

Edge cases: null texts count as empty, and all empty texts are equal; rows with a null identifier take
part like others, and stay only where no row of the group with as long a text has an identifier; of
rows that share identifier and length one stays; columns of the results' names are replaced; an empty
table gives none. A very long text is one row of hashes, and adds rounds by the logarithm of its length.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, others, written

BLOCK_BYTES = 4096
#: Bits of a hash by which keys are dealt out for sorting.
PIECE_BITS = 12
#: Fixed value: what normalising deletes.
SPACE = " \t\n\x0b\f\r"

Spread = Callable[[Column, int], Column]


def normalised(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), SPACE, "")


def spread(block: Column, seed: int) -> Column:
    """The 128 bits of hash that blocks are sorted by."""
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("a"), F.xxhash64(F.lit(2 * seed + 1), block).alias("b"))


def blocks(body: Column, size: int) -> Column:
    """The blocks of a text's bytes, in order; an empty text has one, which is empty."""
    last = lambda b: F.greatest(F.ceil(F.length(b) / size).cast("int") - 1, F.lit(0))
    return let(F.encode(body, "UTF-8"), lambda b: F.transform(F.sequence(F.lit(0), last(b)), lambda i: b.substr(i * size + 1, F.lit(size))))


def told_apart(bodies: DataFrame, size: int, hashed: Spread) -> tuple[DataFrame, int]:
    """The distinct hashes (a, b) of all blocks of ``body``, and the first seed with which no two blocks share one."""
    seed = 0
    while True:
        each = bodies.select(F.explode(blocks(F.col("body"), size)).alias("block")).select("block", hashed(F.col("block"), seed).alias("h"))
        ends = each.groupBy("h.a", "h.b").agg(F.min("block").alias("least"), F.max("block").alias("most"))
        found = written(ends.select("a", "b", (F.col("least") == F.col("most")).alias("alone")), "naming-blocks")
        if found.where("not alone").isEmpty():
            return found.select("a", "b"), seed
        seed += 1


def places(keys: DataFrame) -> DataFrame:
    """The distinct (a, b) with ``name``: their places in an order, from 0.

    The order is that of (hash, a, b); each piece of the hash's range is sorted on its own, behind
    the count of those before it.
    """
    rows = keys.withColumn("h", F.xxhash64("a", "b")).withColumn("piece", F.shiftrightunsigned("h", 64 - PIECE_BITS))
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 ** PIECE_BITS rows
    firsts = rows.groupBy("piece").agg(F.count("*").alias("n")).select("piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("piece").orderBy("h", "a", "b"))
    ranked = rows.withColumn("within", within).join(F.broadcast(firsts), "piece")
    return ranked.select("a", "b", (F.col("first") + F.col("within") - 1).alias("name"))


def identified(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(row, round, name), the same (round, name) for equal sequences of pairs and for no others.

    ``pairs`` has (row, n, pos, a, b): n pairs of each row; ``distinct`` all (a, b) that there are.
    """
    ready, turn = [], 0
    while True:
        names = written(places(distinct), f"naming-names-{turn}")
        named = written(pairs.join(names, ["a", "b"]).select("row", "n", "pos", "name"), f"naming-{turn}")
        ready.append(named.where("n = 1").select("row", F.lit(turn).alias("round"), "name"))
        more = named.where("n > 1")
        if more.isEmpty():
            return reduce(DataFrame.unionByName, ready)
        side = lambda k: F.max(F.when(F.col("pos") % 2 == k, F.col("name")))  # noqa: E731, B023
        folded = more.groupBy("row", "n", F.shiftright("pos", 1).alias("half")).agg(side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b"))
        pairs = written(folded.select("row", F.shiftright(F.col("n") + 1, 1).alias("n"), F.col("half").alias("pos"), "a", "b"), f"naming-pairs-{turn}")
        distinct, turn = pairs.select("a", "b").distinct(), turn + 1


def dedupe(df: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, hashed: Spread = spread) -> DataFrame:
    """Adds keep_id, group_size, kept and text_sha256 to every row and drops the text; see the module.

    Of equal texts the row of the longest original text stays, then that of the smallest identifier.
    """
    new = ["keep_id", "group_size", "kept", "text_sha256"]
    rest = [F.col(f"`{c}`") for c in others(df, [*new, text])]
    ident, chars = F.col(f"`{key}`").cast("long"), F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long")
    rows = df.select(F.struct(*rest).alias("rest"), ident.alias("id"), chars.alias("chars"), normalised(text).alias("body"))
    distinct, seed = told_apart(rows.select("body"), block_bytes, hashed)
    hashes = F.transform(blocks(F.col("body"), block_bytes), lambda b: hashed(b, seed))
    # What the rows need besides, and their numbers, for good.
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "rest", "id", "chars", F.sha2("body", 256).alias("sha"), hashes.alias("hashes"))
    rows = written(rows, "naming-rows")
    pairs = rows.select("row", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h")).select("row", "n", "pos", "h.a", "h.b")
    known = written(rows.drop("hashes").join(identified(pairs, distinct), "row"), "naming-known")
    first = F.min(F.struct(-F.col("chars"), F.col("id").isNull(), F.col("id"), F.col("row"))).alias("first")
    groups = written(known.groupBy("round", "name").agg(F.count("*").alias("n"), first), "naming-groups")
    found = known.join(groups.select("round", "name", "n", F.col("first.id").alias("keep_id"), F.col("first.row").alias("first_row")), ["round", "name"])
    return found.select("rest.*", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("first_row")).alias("kept"), F.col("sha").alias("text_sha256"))
