"""Exact top-k search by inner product: tiled matrix products, partial selection, a tree of merges.

Queries are dealt into blocks and candidates into stripes; every (block, stripe) pair is one cell, worked on by
one task. It holds the block, streams the stripe in tiles, each of which is one matrix product, and keeps a running list of
the k best for each query. Stripes are as many as keep all cores busy (or as ``PAIRS`` asks for), so a candidate travels once
a block, a query once a stripe, and lists are as many as queries and stripes. They merge in a tree: in each round the lists of
``FAN_IN`` neighbours become one, so no task sees all lists of a query.

Integer scores are exact at any size: vectors travel in the narrowest integers that hold them, sums
below 2**53 are products of doubles, and larger components are cut into limbs whose products are.
Scores beyond a long are ranked exactly and given as the nearest long.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part; a query
meets the vectors of its own length, so each length is a search of its own; a query's own row, and
any row of the same identifier, never answers it; ties go to the smaller identifier; repeated
identifiers are rows of their own, but query rows that share one share one list; fewer than k
candidates give fewer rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced

#: Queries in a block, candidates in a tile, queries in one matrix product.
QUERY_BLOCK, TILE, SLAB = 65536, 4096, 1024
#: Bytes of a block, of rows that are held before they are dealt, and of a tile. Products of a cell, and cells of a core at least.
BYTES, PAIRS, CELLS = 16 << 20, 2**35, 2
#: Lists that become one in a round of merging.
FAN_IN = 16
#: Sums of integers up to here are exact in doubles.
EXACT = 2**53
#: Scores beyond are cut to it where they are rounded to doubles.
HUGE = 1 << 1000
#: Bits of a digit of scores that doubles can't hold, and a score below all others.
DIGIT, BARRED = 62, -(1 << 2200)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(d, ids, rows, q) of the batch's vectors of each length d."""
    ids, vectors, q = (batch.column(n) for n in ("id", "v", "q"))
    flat, sizes = vectors.flatten().to_numpy(zero_copy_only=False), vectors.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    ids, q = ids.to_numpy().astype("<i8"), q.to_numpy(zero_copy_only=False).astype(bool)
    for d in np.unique(sizes):
        own = np.flatnonzero(sizes == d)
        yield int(d), ids[own], flat[starts[own][:, None] + np.arange(d)], q[own]


def dealt(rows: DataFrame, blocks: int, stripes: int, kind: str) -> DataFrame:
    """(cell, d, side, ids, rows): identifiers and vectors of one length as binary chunks for each cell, queries (side 0) first.

    Each task deals its rows over all blocks and stripes in turn, whatever they hold, so these are of equal size and equal rows don't meet.
    """

    def deal(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        turn, size = [TaskContext.get().partitionId()] * 2, 0

        def emptied() -> Iterator[pa.RecordBatch]:
            for d, parts in held.items():
                ids, rows, q = (np.concatenate(c) for c in zip(*parts))
                for side, own_ids, own, m in ((0, ids[q], rows[q], blocks), (1, ids, rows, stripes)):
                    for i in range(min(m, len(own_ids))):
                        chunk = own_ids[i::m].tobytes(), own[i::m].astype(kind).tobytes()
                        yield pa.RecordBatch.from_pylist([{"part": (turn[side] + i) % m, "d": d, "side": side, "ids": chunk[0], "rows": chunk[1]}], packed)
                    turn[side] += len(own_ids)
            held.clear()

        for batch in sliced(of):
            for d, ids, own, q in by_length(batch):
                held.setdefault(d, []).append((ids, own, q))
                size += own.nbytes
            if size > BYTES:
                yield from emptied()
                size = 0
        yield from emptied()

    packed = pa.schema([("part", pa.int64()), ("d", pa.int64()), ("side", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary())])
    chunks = rows.select("id", "v", "q").mapInArrow(deal, "part long, d long, side int, ids binary, rows binary")
    # Cell: block * stripes + stripe. A stripe goes to all blocks, a block to all stripes.
    first = F.when(F.col("side") == 0, F.col("part") * stripes).otherwise(F.col("part"))
    step, most = F.when(F.col("side") == 0, F.lit(1)).otherwise(F.lit(stripes)).cast("long"), F.when(F.col("side") == 0, F.lit(stripes)).otherwise(F.lit(blocks)) - 1
    chunks = chunks.select(F.explode(F.sequence(first, first + step * most, step)).alias("cell"), "d", "side", "ids", "rows")
    return chunks.repartitionById(blocks * stripes, F.col("cell").cast("int")).sortWithinPartitions("cell", "d", "side")


def limbs(rows: np.ndarray, bits: int) -> list[np.ndarray]:
    """Whole numbers as sums of limb[i] << (i * bits), each limb below 2**bits in size."""
    found = []
    while rows.any():
        rest = np.trunc(np.ldexp(rows, -bits))
        found.append(rows - np.ldexp(rest, bits))
        rows = rest
    return found


def products(left: np.ndarray, right: np.ndarray, wide: bool) -> np.ndarray:
    """All inner products; if ``wide``, of whole numbers and as Python integers."""
    if not wide:
        return left @ right.T
    most = lambda x: float(np.abs(x).max(initial=0))
    if most(left) * most(right) * left.shape[1] < EXACT:
        return (left @ right.T).astype(np.int64).astype(object)
    bits = (52 - int(np.ceil(np.log2(left.shape[1])))) // 2
    out = np.zeros((len(left), len(right)), object)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(limbs(right, bits)):
            out += (a @ b.T).astype(np.int64).astype(object) << (i + j) * bits
    return out


def select_top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row by score descending, then identifier ascending.

    ``ids`` has a row for each row of scores, or one for all. Scores are cut by their rounded values
    first, which keeps all that could be among the best, then by their exact ones.
    """
    n = scores.shape[1]
    rough = scores if scores.dtype != object else np.array([[float(max(min(x, HUGE), -HUGE)) for x in row] for row in scores]).reshape(scores.shape)
    if n > k:
        at = np.argpartition(rough, n - k, axis=1)[:, n - k :]
        least = np.take_along_axis(rough, at, 1).min(axis=1)
        ties = (rough >= least[:, None]).sum(axis=1)
        wide = int(ties.max(initial=k))
        if wide > k:  # rows with ties at the cut take part with all of them
            at = np.argpartition(rough, n - wide, axis=1)[:, n - wide :]
    else:
        at = np.broadcast_to(np.arange(n), scores.shape)
    own_ids = np.take_along_axis(np.broadcast_to(ids, scores.shape), at, 1)
    own = np.take_along_axis(scores, at, 1)
    if own.dtype == object:
        order = np.array([sorted(range(own.shape[1]), key=lambda c, s=s, i=i: (-s[c], i[c])) for s, i in zip(own, own_ids)], np.int64).reshape(own.shape)
    else:
        order = np.lexsort((own_ids, -own), axis=1)
    order = order[:, :k]
    return np.take_along_axis(own_ids, order, 1), np.take_along_axis(own, order, 1)


def merged(best: tuple | None, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row of ``best`` (ids, scores) and of a tile's scores.

    Only scores that reach the row's last one so far can be among the best; once lists are full these are few.
    """
    if best is None:
        return select_top(scores, ids[None, :], k)
    rows = np.arange(len(scores))
    if scores.dtype != object and best[1].shape[1] == k:
        row, column = np.nonzero(scores >= best[1][:, -1:])
        counts = np.bincount(row, minlength=len(scores))
        if (wide := int(counts.max(initial=0))) <= scores.shape[1] // 4:
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            own, own_ids = np.full((len(scores), wide), -np.inf, scores.dtype), np.zeros((len(scores), wide), np.int64)
            own[row, place], own_ids[row, place] = scores[row, column], ids[column]
            rows = np.flatnonzero(counts)
            scores, ids = own[rows], own_ids[rows]
    if not len(rows):
        return best
    if ids.ndim == 1:
        ids, scores = select_top(scores, ids[None, :], k)
    found = select_top(np.hstack([best[1][rows], scores]), np.hstack([best[0][rows], ids]), k)
    if len(rows) == len(best[1]):
        return found
    best[0][rows], best[1][rows] = found
    return best


def digits(score: int, n: int) -> list[int]:
    """The score as n digits, the highest (which has the sign) first: such lists sort as scores do."""
    return [score >> DIGIT * (n - 1)] + [score >> DIGIT * i & (1 << DIGIT) - 1 for i in range(n - 2, -1, -1)]


def nearest_long(score: Column, n: int) -> Column:
    """The long that n digits stand for, or the one nearest to them."""
    if n == 1:
        return F.element_at(score, 1)
    beyond = lambda x: F.when(x > 0, F.lit(4)).otherwise(F.lit(-4)).cast("long")
    high = F.aggregate(F.slice(score, 2, n - 2), F.element_at(score, 1), lambda x, d: F.when(x == 0, d).when(x == -1, d - (1 << DIGIT)).otherwise(beyond(x)))
    return F.when(high.between(-2, 1), F.shiftleft(high, DIGIT) + F.element_at(score, n)).otherwise(F.when(high > 0, F.lit(2**63 - 1)).otherwise(F.lit(-(2**63))))


def top_k(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: float | None = None, query_block: int = QUERY_BLOCK, tile: int = TILE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best inner products for every query row.

    ``scale`` turns each component x into floor(scale * x) first; scores are exact longs then, and
    doubles otherwise.
    """
    spark, whole = df.sparkSession, scale is not None
    x = F.col(f"`{vector}`")
    clean = x.isNotNull() & F.col(f"`{key}`").isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    v = F.transform(x, lambda c: c.cast("double"))
    if whole:
        # A double beyond 2**53 is whole, and a long could not hold it.
        scaled = lambda c: F.lit(float(scale)) * c
        v = F.transform(v, lambda c: F.when(F.abs(scaled(c)) < float(EXACT), F.floor(scaled(c)).cast("double")).otherwise(scaled(c)))
    rows = df.where(clean).select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v"), is_query.alias("q")).where(F.size("v") > 0)
    rows = rows.where(~F.exists("v", lambda c: F.abs(c) == float("inf")))
    n, nq, top, longest = rows.agg(F.count("*"), F.count_if("q"), F.max(F.array_max(F.transform("v", lambda c: F.abs(c)))), F.max(F.size("v"))).first()
    schema = f"query_id long, rank int, vec_id long, score {'long' if whole else 'double'}"
    if not nq:
        return spark.createDataFrame([], schema)
    narrow, kind = next(((t, k) for t, k, most in (("tinyint", "<i1", 127), ("smallint", "<i2", 32767), ("int", "<i4", 2**31 - 1)) if whole and top <= most), ("double", "<f8"))
    rows = rows.withColumn("v", F.col("v").cast(f"array<{narrow}>"))
    wide = whole and top * top * longest >= EXACT
    n_digits = int(2 * np.log2(top) + np.log2(longest) + 2) // DIGIT + 1 if wide else 1
    blocks = -(-nq // max(1, min(query_block, BYTES // (longest * np.dtype(kind).itemsize))))
    most = max(CELLS * spark.sparkContext.defaultParallelism, n * nq // PAIRS + 1)
    stripes = max(1, min(-(-n // tile), -(-most // blocks)))
    cells = dealt(rows, blocks, stripes, kind)
    # Sums of small integers are exact in single precision too.
    real = np.float32 if whole and top * top * longest < 2**24 else float
    out_schema = pa.schema([("node", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.list_(pa.int64()) if wide else pa.float64())])

    def lists(stripe: int, q_ids: np.ndarray, best_ids: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
        flat = best.ravel()
        ok = (flat > BARRED).astype(bool) if wide else np.isfinite(flat)
        query, found = np.repeat(q_ids, best.shape[1])[ok], best_ids.ravel()[ok]
        scores = [digits(s, n_digits) for s in flat[ok]] if wide else flat[ok].astype(float)
        node = np.full(len(query), stripe, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((node, query, found, scores), out_schema)], schema=out_schema)

    def barred(scores: np.ndarray, q_ids: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Without the products of a query and rows of its own identifier."""
        order = np.argsort(ids, kind="stable")
        lo, hi = np.searchsorted(ids[order], q_ids, "left"), np.searchsorted(ids[order], q_ids, "right")
        for i in np.flatnonzero(hi > lo):
            scores[i, order[lo[i] : hi[i]]] = BARRED if wide else -np.inf
        return scores

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, queries, waiting, best = None, [], [], []

        def work() -> None:
            """The waiting candidates, in tiles."""
            if not waiting or not queries:
                waiting.clear()
                return
            if len(queries) > 1:
                queries[:] = [tuple(np.concatenate(c) for c in zip(*queries))]
            (q_ids, q_rows), d = queries[0], at[1]
            best.extend([None] * (-(-len(q_ids) // SLAB) - len(best)))
            ids, rows = (np.concatenate(c) for c in zip(*waiting))
            waiting.clear()
            step = max(1, min(tile, 4 * BYTES // (8 * d)))
            for j in range(0, len(ids), step):
                own, right = ids[j : j + step], rows[j : j + step].astype(real)
                for i in range(len(best)):
                    part = slice(i * SLAB, (i + 1) * SLAB)
                    scores = barred(products(q_rows[part].astype(real), right, wide), q_ids[part], own)
                    best[i] = merged(best[i], own, scores, k)

        def ended() -> Iterator[pa.RecordBatch]:
            work()
            for i, one in enumerate(best):
                yield lists(at[0] % stripes, queries[0][0][i * SLAB : (i + 1) * SLAB], *one)
            queries.clear()
            best.clear()

        for batch in sliced(of):
            for cell, d, side, ids, rows in zip(*(c.to_pylist() for c in batch.columns)):
                if (cell, d) != at:
                    yield from ended()
                    at = (cell, d)
                chunk = np.frombuffer(ids, "<i8"), np.frombuffer(rows, kind).reshape(-1, d)
                (waiting if side else queries).append(chunk)
                if side and sum(len(c[0]) for c in waiting) >= tile or sum(c[1].nbytes for c in waiting) > BYTES:
                    work()
        yield from ended()

    found = cells.mapInArrow(run, f"node long, query_id long, vec_id long, score {'array<long>' if wide else 'double'}")
    # The tree: a list's first node is its stripe, and nodes get fewer by FAN_IN each round.
    nodes = stripes
    while True:
        found, nodes = found.withColumn("node", F.floor(F.col("node") / FAN_IN)), -(-nodes // FAN_IN)
        last = nodes == 1
        by = Window.partitionBy(*(["query_id"] if last else ["query_id", "node"])).orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        if last:
            break
        found = found.drop("rank")
    score = nearest_long(F.col("score"), n_digits) if wide else F.col("score").cast("long") if whole else F.col("score")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
