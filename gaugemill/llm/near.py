"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are linked when their sets of word shingles (lower-cased words between white space, five at
a time; a shorter text is one shingle) have a Jaccard similarity of at least the threshold.

1. Equal texts become one class of copies; every class gets ``BANDS * ROWS`` MinHash values.
2. Classes that share a band of values are candidates. Pairs in a bucket are compared a few values
   at a time; under a uniform prior the posterior of the similarity after m of n agreements is
   Beta(m + 1, n - m + 1), and a pair is dropped as soon as the chance that it reaches the
   threshold is below ``TOLERANCE``.
3. The pairs that are left, and no others, are verified exactly by whole sets of 64-bit shingle hashes.
   Each pair is left in one bucket only, that of its first common band, so it is verified once.

Large buckets are dealt into blocks, and each pair of blocks is a cell of its own, so no task holds
a whole bucket. A cell's surviving pairs travel as a matrix of bits beside its classes, in cells of ``CELL_BYTES``
of hashes on either side, so what a task verifies at a time is bounded by bytes. Tasks send sums of links
and one edge for each class, never all pairs.
A pair at the threshold misses every band with a chance of (1 - 0.8**4)**32 < 1e-7.

Results have one row for each row of the input: ``class_id`` is the smallest identifier among all
texts connected by links, ``copy_id`` the smallest among equal texts, ``n_links`` the number of
other documents that the document is linked to. Edge cases: null texts count as empty; texts
without words link only to texts equal to them; rows that share an identifier count as rows, and
are linked by their texts alone; rows with a null identifier are in no class and have no links;
columns of the results' names are replaced; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import adding, others, sliced, written

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
STEP = 16
TOLERANCE = 1e-7
#: Classes in one block of a bucket, and bytes of hashes on either side of a cell that is verified.
BUCKET_BLOCK, CELL_BYTES = 1024, 8 << 20
#: Pairs compared at a time, and entries (classes times shingles) of a matrix that is multiplied.
PAIRS, MATRIX = 1 << 16, 1 << 22
#: Cells in which a larger share of all pairs survived are verified by matrix products.
DENSE = 1 / 16
#: Classes of candidates are broadcast up to so many rows of a digest and three numbers, and shuffled beyond.
BROADCAST_ROWS = 200_000
#: Texts with more copies, of which there are fewer than BROADCAST_ROWS, meet their class by broadcast.
HOT_COPIES = 10_000

BASE = 0x9E3779B97F4A7C15


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (self.row(b, size) for b in (BASE, pow(BASE, -1, 1 << 64)))
        return self.up, self.down

    @staticmethod
    def row(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


POWERS = Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    joined = " ".join((text or "").lower().split()).encode()
    if not joined:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(joined, np.uint8)
    up, down = POWERS.upto(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.append(gaps, len(raw))
    n = max(len(starts) - words + 1, 1)
    starts, ends = starts[:n], ends[min(words, len(ends)) - 1 :]
    return np.unique(mixed((sums[ends] - sums[starts]) * down[starts]))


@lru_cache(1)
def hash_functions() -> tuple[np.ndarray, np.ndarray]:
    raw = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(BASE))
    return raw[: BANDS * ROWS, None], raw[BANDS * ROWS :, None] | np.uint64(1)


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """BANDS numbers of 64 bits, each made of ROWS MinHash values of 16 bits."""
    flip, times = hash_functions()
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        np.minimum(least, ((hashes[i : i + 2048] ^ flip) * times).min(axis=1), out=least)
    return (mixed(least) >> np.uint64(48)).astype("<u2").view("<i8")


@lru_cache(8)
def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For n = STEP, 2 STEP, ...: the fewest agreements of n that are not dropped.

    The posterior chance of reaching the threshold t after m of n agreements equals the chance
    that a binomial of n + 1 trials at t is at most m.
    """
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


class Links:
    """Union-find over the rows of a cell."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def pairs_of(ends: np.ndarray, block: np.ndarray, crossed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (left, right) within runs of rows, about PAIRS at a time.

    ``ends`` has the end of each row's own run; a crossed run takes only pairs of unlike blocks.
    """
    row = np.arange(len(ends))
    counts = ends - row - 1
    before = np.concatenate([[0], np.cumsum(counts)])
    i = 0
    while i < len(row):
        j = max(int(np.searchsorted(before, before[i] + PAIRS, "right")) - 1, i + 1)
        own = counts[i:j]
        left = np.repeat(row[i:j], own)
        right = left + 1 + np.arange(len(left)) - np.repeat(before[i:j] - before[i], own)
        keep = ~crossed[left] | (block[left] != block[right])
        yield left[keep], right[keep]
        i = j


def surviving(keys: np.ndarray, band: np.ndarray, left: np.ndarray, right: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose first common band is this one and that no comparison drops."""
    first = (keys[left] == keys[right]).argmax(axis=1) == band[left]
    left, right = left[first], right[first]
    values = np.ascontiguousarray(keys).view("<u2").reshape(len(keys), -1)
    same = np.zeros(len(left), np.int64)
    for k, most in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        same += (values[left, part] == values[right, part]).sum(axis=1)
        keep = same >= most
        left, right, same = left[keep], right[keep], same[keep]
    return left, right


def prune(cells: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(nodes, pairs): the classes of surviving pairs, and which pairs survived, as bits of a square matrix.

    ``cells`` has (cell, crossed, block, band, node, size, keys), with equal cells next to each other; ``size`` is
    the number of a class's shingles, by which the results are cut.
    """
    least, cell_bytes = least_matches(threshold, tolerance), CELL_BYTES
    schema = pa.schema([("nodes", pa.list_(pa.int64())), ("pairs", pa.binary())])

    def cut(left: np.ndarray, right: np.ndarray, nodes: np.ndarray, size: np.ndarray) -> Iterator[tuple[list[int], bytes]]:
        """The surviving pairs of one cell by blocks of its classes."""
        used = np.unique(np.concatenate([left, right]))
        block = np.zeros(len(nodes), np.int64)
        block[used] = (np.cumsum(8 * size[used]) - 1) // cell_bytes
        x, y = np.minimum(block[left], block[right]), np.maximum(block[left], block[right])
        order = np.lexsort((y, x))
        x, y, left, right = x[order], y[order], left[order], right[order]
        for part in np.split(np.arange(len(left)), np.flatnonzero((x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1):
            own = np.unique(np.concatenate([left[part], right[part]]))
            bits = np.zeros((len(own), len(own)), bool)
            bits[np.searchsorted(own, left[part]), np.searchsorted(own, right[part])] = True
            yield nodes[own].tolist(), np.packbits(bits).tobytes()

    def work(cell, crossed, block, band, nodes, size, keys) -> Iterator[pa.RecordBatch]:
        change = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        bounds = np.concatenate([[0], change, [len(cell)]])
        ends = np.repeat(bounds[1:], np.diff(bounds))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        upto = 0
        for left, right in pairs_of(ends, block, crossed):
            left, right = surviving(keys, band, left, right, least)
            # Runs come in order, so those before the last row's run are complete.
            found.append((left, right))
            if len(left) and ends[left[-1]] > upto:
                yield from whole(found, int(bounds[np.searchsorted(bounds, left[-1], "right") - 1]), bounds, nodes, size)
                upto = ends[left[-1]]
        yield from whole(found, len(cell), bounds, nodes, size)

    def whole(found: list, before: int, bounds: np.ndarray, nodes: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The results of all runs that end by ``before``, whose pairs are taken out of ``found``."""
        left, right = (np.concatenate([f[i] for f in found]) for i in (0, 1)) if found else (np.zeros(0, np.int64),) * 2
        done = left < before
        found[:] = [(left[~done], right[~done])]
        left, right = left[done], right[done]
        run = np.searchsorted(bounds, left, "right") - 1
        rows = []
        for part in np.split(np.arange(len(left)), np.flatnonzero(run[1:] != run[:-1]) + 1) if len(left) else ():
            first = bounds[run[part[0]]]
            own = slice(first, bounds[run[part[0]] + 1])
            rows += cut(left[part] - first, right[part] - first, nodes[own], size[own])
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in of:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            held.append((*columns, batch.column(6).flatten().to_numpy().reshape(batch.num_rows, BANDS)))
            if sum(len(x[0]) for x in held) < 8192:
                continue
            rows = [np.concatenate(x) for x in zip(*held)]
            last = int(np.flatnonzero(np.append(True, rows[0][1:] != rows[0][:-1]))[-1])  # the last cell may go on
            if last:
                yield from work(*(x[:last] for x in rows))
            held = [tuple(x[last:] for x in rows)]
        if held:
            yield from work(*(np.concatenate(x) for x in zip(*held)))

    return cells.mapInArrow(run, "nodes array<long>, pairs binary")


def dealt(rows: DataFrame, id_column: str, size: str, block_rows: int) -> DataFrame:
    """Adds (block, x, y): rows of one bucket in blocks, each row in all cells of its block."""
    blocks = F.ceil(F.col(size) / block_rows)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(id_column), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    return rows.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other")).drop("other")


def verify(cells: DataFrame, threshold: float) -> DataFrame:
    """(id, root, links, pairs): for each class in a cell one it is connected to, its links there, and how many
    of the cell's pairs were verified (with the first class).

    ``cells`` has (cell, pos, node, copies, hashes), with equal cells next to each other and classes in order of
    ``pos``; at -1 comes the matrix of the pairs to verify, as ``prune`` gives it.
    """
    dense, schema = DENSE, pa.schema([("id", pa.int64()), ("root", pa.int64()), ("links", pa.int64()), ("pairs", pa.int64())])

    def common(sets: list[np.ndarray]) -> np.ndarray:
        """The sizes of all intersections, by products of blocks of an incidence matrix."""
        n = len(sets)
        whole, counts = np.unique(np.concatenate(sets), return_counts=True)
        whole = whole[counts > 1]
        out = np.zeros((n, n), np.float64)
        places = []
        for s in sets:
            at = np.searchsorted(whole, s)
            at[at == len(whole)] = 0
            places.append(at[whole[at] == s] if len(whole) else at[:0])
        width = max(MATRIX // n, 1)
        for c in range(0, len(whole), width):
            matrix = np.zeros((n, min(width, len(whole) - c)), np.float32)
            for i, at in enumerate(places):
                lo, hi = np.searchsorted(at, [c, c + width])
                matrix[i, at[lo:hi] - c] = 1
            out += matrix @ matrix.T
        return out

    def shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The sizes of the pairs' intersections."""
        if len(left) > dense * len(sets) ** 2 and len(sets) > 6:
            return np.rint(common(sets)[left, right]).astype(np.int64)
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left.tolist(), right.tolist())])

    def work(bits: bytes, ids: list[int], copies: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        k, n, size = len(ids), np.array([len(s) for s in sets]), np.array(copies)
        left, right = np.nonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=k * k).reshape(k, k))
        pairs = np.zeros(k, np.int64)
        pairs[0] = len(left)
        both = shared(sets, left, right)
        linked = (both > 0) & (both >= threshold * (n[left] + n[right] - both) - 1e-9)
        left, right = left[linked], right[linked]
        total = np.bincount(left, size[right], k) + np.bincount(right, size[left], k)
        order = np.argsort(ids)
        place = np.empty(k, np.int64)
        place[order] = np.arange(k)
        links = Links(k)
        for a, b in zip(place[left].tolist(), place[right].tolist()):
            links.join(a, b)
        roots = [ids[order[links.root(int(place[i]))]] for i in range(k)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, roots, np.rint(total).astype(np.int64), pairs)], schema=schema)

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bits, held = None, b"", []
        for batch in sliced(of):
            for cell, pos, node, copies, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if cell != key:
                    if held:
                        yield work(bits, *map(list, zip(*held)))
                    key, held = cell, []
                if pos < 0:
                    bits = raw
                else:
                    held.append((node, copies, np.frombuffer(raw, np.uint64)))
        if held:
            yield work(bits, *map(list, zip(*held)))

    return cells.mapInArrow(run, "id long, root long, links long, pairs long")


def narrowed(edges: DataFrame) -> DataFrame:
    """Fewer edges that connect the same: each end keeps its smallest neighbour, and its other
    smaller neighbours are joined to that one instead."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    least = F.min("b").over(Window.partitionBy("a"))
    return ordered.select("a", "b", least.alias("least")).select(F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of all ends of the edges (a, b): the smallest identifier they connect to.

    Labels spread along edges and by jumps to the label's own label; each round is a written table.
    """
    ways = narrowed(narrowed(edges))
    ways = written(ways.union(ways.select("b", "a")).distinct(), "edges")
    labels = written(ways.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = ways.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        new = labels.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("jump"))
        new = written(new.join(jump, "label").select("id", F.least("label", "jump").alias("label"), "old"), "labels")
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("id", "label")
        if not changed:
            return labels


def classified(df: DataFrame, key: str, text: str, words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame | None]:
    """(alike, class_id, copy_id, n_links, stays): one row for each class of equal texts.

    Classes have numbers of their own through all steps, so an identifier may have many texts.
    ``stays`` tells whether the class has its group's row of the smallest identifier (and text).
    The second table has ``alike`` of the texts with very many copies, None if there are none.
    """
    ident, body = F.col(f"`{key}`").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(ident.alias("id"), alike(text).alias("alike"), body.alias("text")).where("id is not null")

    def sketch():
        def use(texts):
            sets = [shingles(t, words) for t in texts]
            return [[minhashes(s) if len(s) else [] for s in sets], [len(s) for s in sets]]

        return use

    sketched = adding(rows, ["text"], {"keys": T.ArrayType(T.LongType()), "size": T.LongType()}, sketch, ("text",))
    classes = sketched.groupBy("alike").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("keys").alias("keys"), F.first("size").alias("size"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "sketches")
    # Candidates: buckets of a band with two classes or more.
    banded = classes.where(F.size("keys") > 0).select("node", F.posexplode("keys").alias("band", "value"))
    full = banded.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    bucketed = dealt(banded.join(full, ["band", "value"]), "node", "n", BUCKET_BLOCK)
    cells = bucketed.select(F.xxhash64("band", "value", "x", "y").alias("cell"), (F.col("x") != F.col("y")).alias("crossed"), "block", "band", "node").join(classes.select("node", "size", "keys"), "node").select("cell", "crossed", "block", "band", "node", "size", "keys")
    cells = cells.repartition(F.col("cell")).sortWithinPartitions("cell")
    left = written(prune(cells, threshold, tolerance).withColumn("cell", F.monotonically_increasing_id()), "pairs")
    # Exact verification of the pairs that are left, with one text of each class.
    members = left.select("cell", F.posexplode("nodes").alias("pos", "node"))
    needed = written(members.select("node").distinct().join(classes.select("node", "alike", "id", "copies"), "node").select("alike", "id", "node", "copies"), "members")
    few = needed.count() <= BROADCAST_ROWS
    texts = rows.join(F.broadcast(needed) if few else needed, ["alike", "id"])
    texts = texts.groupBy("node", "copies").agg(F.first("text").alias("text"))

    def whole():
        return lambda texts: [[shingles(t, words).tobytes() for t in texts]]

    sets = adding(texts, ["text"], {"hashes": T.BinaryType()}, whole, ("text",))
    spread = sets.join(members, "node").select("cell", "pos", "node", "copies", "hashes")
    spread = spread.unionByName(left.select("cell", F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("copies"), F.col("pairs").alias("hashes")))
    spread = spread.repartition(F.col("cell")).sortWithinPartitions("cell", "pos")
    found = written(verify(spread, threshold), "links")
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "node")
    counted = found.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("links"))
    least = labels.join(classes.select("node", "id", "alike"), "node").groupBy("label").agg(F.min(F.struct("id", "alike")).alias("least"))
    known = classes.select("alike", "id", "copies", "node").join(labels.join(least, "label"), "node", "left").join(counted, "node", "left")
    stays = F.coalesce(F.col("least.alike") == F.col("alike"), F.lit(True)).alias("stays")
    known = known.select("alike", F.coalesce("least.id", "id").alias("class_id"), F.col("id").alias("copy_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), stays)
    total, most = classes.agg(F.sum("copies"), F.max("copies")).first()
    bound = max(HOT_COPIES, (total or 0) // BROADCAST_ROWS)
    return known, classes.where(F.col("copies") > bound).select("alike") if (most or 0) > bound else None


def with_classes(rows: DataFrame, known: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Rows (with ``__alike``) and what is known of their classes, without a task for all rows of a hot text."""
    known = known.withColumnRenamed("alike", "__alike")
    if hot is None:
        return rows.join(known, "__alike", "left")
    hot = F.broadcast(hot.withColumnRenamed("alike", "__alike"))
    often = rows.join(F.broadcast(known.join(hot, "__alike", "left_semi")), "__alike")
    return often.unionByName(rows.join(hot, "__alike", "left_anti").join(known, "__alike", "left"))


def alike(text: str) -> Column:
    """What equal texts have in common."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def link(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds class_id, copy_id and n_links (long) to every row; see the module."""
    known, hot = classified(df, key, text, words, threshold, tolerance)
    new = ["class_id", "copy_id", "n_links"]
    kept = [F.col(f"`{c}`") for c in others(df, new)]
    has = F.col(f"`{key}`").cast("long").isNotNull()
    base = df.where(has).select(*kept, alike(text).alias("__alike"))
    joined = with_classes(base, known.drop("stays"), hot).drop("__alike")
    # Rows without an identifier need no join, in which they would share one key.
    rest = df.where(~has).select(*kept, *[F.lit(None).cast("long").alias(c) for c in new[:2]], F.lit(0).cast("long").alias(new[2]))
    return joined.unionByName(rest)


def dedupe(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group of linked texts: the one with the smallest identifier.

    Rows without an identifier stay. Rows that share an identifier stay if their texts aren't
    linked; of those with equal texts one stays.
    """
    keyed = df.withColumn("__id", F.col(f"`{key}`").cast("long")).withColumn("__alike", F.when(F.col("__id").isNotNull(), alike(text)))
    pairs = keyed.where(F.col("__id").isNotNull()).groupBy("__id", "__alike").agg(F.count("*").alias("n"))
    known, hot = classified(df, key, text, **options)
    pairs = written(with_classes(pairs, known.select("alike", "class_id", "stays"), hot).select("__id", "__alike", "n", (~F.col("stays") | (F.col("class_id") != F.col("__id"))).alias("goes")), "copies")
    gone = pairs.where("goes").select("__id", "__alike")
    few = gone.count() <= BROADCAST_ROWS
    kept = keyed.join(F.broadcast(gone) if few else gone, ["__id", "__alike"], "left_anti")
    if pairs.where("n > 1 and not goes").limit(1).count():
        kept = kept.where(F.col("__id").isNotNull()).dropDuplicates(["__id", "__alike"]).unionByName(kept.where(F.col("__id").isNull()))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
