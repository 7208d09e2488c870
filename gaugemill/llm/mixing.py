"""Mixing sources to target weights: proportional-fair schedules with windows.

A source of weight w (all weights sum to one) owns, in an endless row of slots, one slot in each
window from floor(j / w) to ceil((j + 1) / w), for its blocks j = 0, 1, ... Each slot goes to the
released block with the earliest deadline. So at every slot every source has less than one block
more or less than its weight asks for. Windows follow from the weights as they are given, in exact
whole numbers, over the whole schedule: nothing is rounded to a period, and no error adds up.

Rows go to blocks of ``block_rows`` by a seeded order within their source. When a source has run
out, its later slots stay empty, so the others keep their windows; no row is dropped or repeated.
The schedule has one entry a block of ``block_rows`` rows, ``BLOCK_ROWS`` unless another number is given, whatever
the size of the table. The driver deals it out piece by piece, in time of blocks times the logarithm of the
sources, and holds ``ENTRIES`` of it at a time; larger blocks make it shorter. Of sources, whose weights the schedule needs
together, there may be ``MOST_SOURCES``; more are refused. Only counts of sources reach the driver, one row a
source; rows find their place by a join, without a global sort.

Edge cases: null sources are a source of their own; sources without a target weight, or with one
of zero, have no share while others have rows, and follow them in equal parts (if no source has a
weight, all have the same); rows that share an identifier, or have none, are ordered by all their
columns, and equal rows take neighbouring places; an empty table stays empty; columns of the
results' names are replaced.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.sinks import write_text
from .common import others, scratch, written

#: Rows of a block, and the most sources that a schedule is made for.
BLOCK_ROWS, MOST_SOURCES = 16, 1 << 20
#: Ranks within a source are counted in so many pieces, which spreads a hot source.
PIECES = 4096
#: The schedule is broadcast up to so many entries of four numbers, and shuffled beyond.
BROADCAST_ENTRIES = 500_000
#: Entries of the schedule that the driver holds at a time.
ENTRIES = 1 << 16


def smoothed(power: float = 0.5) -> Column:
    """A target weight from the column n of row counts: n ** power, to flatten large sources."""
    return F.pow(F.col("n").cast("double"), F.lit(power))


def shares(counts: DataFrame, weight: Column | None = None) -> DataFrame:
    """(source, n, part): each source's part of all slots by its weight, of which the largest is 1.

    ``counts`` has (source, n), one row a source; ``weight`` is computed on it.
    """
    w = F.coalesce(weight if weight is not None else smoothed(), F.lit(0.0)).cast("double")
    rows = counts.withColumn("w", F.when((w > 0) & (w < math.inf), w).otherwise(0.0))
    most = F.max("w").over(Window.partitionBy())
    return rows.select("source", "n", F.when(most > 0, F.col("w") / most).otherwise(1.0).alias("part"))


def schedule(weights: list[float], blocks: list[int] | None = None) -> Iterator[tuple[int, int, int]]:
    """(slot, place, j) in order of slots: block j of the source at ``place`` of ``weights``.

    Without ``blocks`` sources never run out. Weights are taken as the exact fractions that they are;
    a window's end within 1e-6 of a whole slot is that slot, as for 0.9, which no fraction of two has.
    """
    exact = [float(w).as_integer_ratio() for w in weights]
    scale = max((b for _, b in exact), default=1)  # powers of two
    whole = [a * (scale // b) for a, b in exact]
    total, slot, dust = sum(whole), 0, [w >> 20 for w in whole]
    ahead: list[tuple[int, int, int]] = []  # (release, place, j)
    ready: list[tuple[int, int, int, int]] = []  # (deadline, -weight, place, j)
    for i, w in enumerate(whole):
        if w and (blocks is None or blocks[i]):
            heapq.heappush(ahead, (0, i, 0))
    while ahead or ready:
        first = None if ready else ahead[0]
        if first and first[2] * total // whole[first[1]] > slot:
            slot = first[0]  # only sources that have run out own the slots between
        while ahead and (ahead[0][0] <= slot or ahead[0] == first):
            _, i, j = heapq.heappop(ahead)
            heapq.heappush(ready, (-((dust[i] - (j + 1) * total) // whole[i]), -whole[i], i, j))
        _, _, i, j = heapq.heappop(ready)
        yield slot, i, j
        slot += 1
        if blocks is None or j + 1 < blocks[i]:
            heapq.heappush(ahead, (((j + 1) * total + dust[i]) // whole[i], i, j + 1))
    rest = [i for i, w in enumerate(whole) if not w and (blocks is None or blocks[i])]
    for at, i, j in schedule([1.0] * len(rest), None if blocks is None else [blocks[i] for i in rest]) if rest else ():
        yield slot + at, rest[i], j


def known_first(source: str | None) -> tuple[bool, str]:
    return source is not None, source or ""


def laid(spark: SparkSession, sources: list, block_rows: int) -> tuple[DataFrame, int]:
    """The written schedule (s, unknown, block, slot, start), and its entries.

    ``sources`` has rows (source, n, part); ``start`` counts the rows before the block.
    """
    path, start, entries = scratch(spark, "mix-schedule"), 0, 0
    order = sorted(sources, key=lambda r: known_first(r.source))
    names = [f'"s":{json.dumps(r.source or "")},"unknown":{json.dumps(r.source is None)}' for r in order]
    slots = schedule([r.part for r in order], [-(-r.n // block_rows) for r in order])
    # Lines of JSON, which Spark reads as a table like any other: no row passes a Python worker.
    while (piece := list(islice(slots, ENTRIES))) or not entries:
        lines = []
        for slot, i, j in piece:
            lines.append(f'{{{names[i]},"block":{j},"slot":{slot},"start":{start}}}\n')
            start += min(block_rows, order[i].n - j * block_rows)
        write_text(spark, f"{path}/part-{entries:012d}.json", "".join(lines))
        entries += len(piece)
        if not piece:
            break
    return spark.read.schema("s string, unknown boolean, block long, slot long, start long").json(path), entries


def mix(df: DataFrame, block_rows: int = BLOCK_ROWS, weight: Column | None = None, source: str = "source", key: str = "doc_id", seed: int = 0) -> DataFrame:
    """Adds mix_block, mix_slot and mix_position (all long, from 0) to every row.

    Rows in order of ``mix_position`` follow the target weights. Columns of these names that the
    table has already are replaced.
    """
    name = F.col(f"`{source}`").cast("string")
    keys = ["s", "unknown", "piece"]
    kept = others(df, ["mix_block", "mix_slot", "mix_position"])
    # By all columns, so that rows which share an identifier are spread and have an order.
    hashed = [F.col(f"`{c}`") for c, k in df.dtypes if c in kept and c != key and "map<" not in k and "variant" not in k]
    order = F.xxhash64(F.lit(seed), F.col(f"`{key}`"), *hashed)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce(name, F.lit("")).alias("s"), name.isNull().alias("unknown"), order.alias("order"))
    rows = rows.withColumn("piece", F.shiftrightunsigned("order", 52))
    # A hot source is ranked piece by piece; pieces start after one another.
    pieces = written(rows.groupBy(*keys).agg(F.count("*").alias("n")), "mix-pieces")
    counts = pieces.groupBy(F.when(~F.col("unknown"), F.col("s")).alias("source")).agg(F.sum("n").alias("n"))
    sources = shares(counts, weight).limit(MOST_SOURCES + 1).collect()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"the column {source!r} has more than {MOST_SOURCES} values; is it a source?")
    slots, entries = laid(df.sparkSession, sources, block_rows)
    before = Window.partitionBy("s", "unknown").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    firsts = pieces.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # A plan without the hint gives the same rows.
    hint = F.broadcast if entries <= BROADCAST_ENTRIES else (lambda x: x)
    ranked = rows.withColumn("i", F.row_number().over(Window.partitionBy(*keys).orderBy("order", F.col(f"row.`{key}`"))).cast("long") - 1)
    ranked = ranked.join(firsts, keys).withColumn("rank", F.col("first") + F.col("i"))
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block_rows))
    at = ranked.join(hint(slots), ["s", "unknown", "block"])
    return at.select("row.*", F.col("block").alias("mix_block"), F.col("slot").alias("mix_slot"), (F.col("start") + F.pmod("rank", F.lit(block_rows))).alias("mix_position"))
