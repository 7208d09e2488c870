"""Embedding whitening by one-sided Jacobi rotations of a blockwise QR factor.

1. One aggregation counts the vectors and sums each dimension, in whole numbers.
2. Tall-skinny QR: each task centres its rows block by block and folds every block into one triangular
   factor; factors of ``MERGE`` tasks at a time are stacked and factored again, until one is left.
   Its columns have the lengths and angles of the centred table's, and no covariance was formed.
3. One-sided Jacobi: plane rotations make the factor's columns orthogonal, disjoint pairs at a time.
   Then lengths of columns are singular values, and the accumulated rotations are the components.
4. A pass over the rows projects them and divides by the standard deviations; its result is
   written, and the covariance of what was written, less the identity, is the error.

Vectors reach one place only as factors of dimension squared (the driver gets the last). Values are
scaled to whole numbers x = floor(scale * c) + shift before anything else, so that sums, and the squared
deviations sum((n * x - S) ** 2), are exact.

Edge cases: vectors that are null, empty, or hold a null or a value that isn't finite (or is 2**40 or
more once scaled, which no sum of 64 bits could take) have no part; of vectors of unlike dimensions the most frequent take part (the longer ones at a tie); repeated rows
count and come back as often as they are there, and null identifiers stay null; components without
spread (fewer rows than dimensions, constant dimensions) can't be whitened and aren't returned, so rows
that are all alike give none; a deviation beyond 64 bits is null in ``deviation`` and whole, as a
decimal, in ``deviation_exact``; columns of the table beside the identifier and the vector are kept, but
for those of the results' names; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import others, written

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Rows that are centred and factored at a time, and factors that are merged at a time.
BLOCK_ROWS, MERGE = 4096, 16
#: A component counts if its share of the largest singular value exceeds this times the dimension.
LEAST = 1e-12
SWEEPS = 60
#: Scaled values are below this, so that a task's sums of them fit 64 bits.
LARGEST = float(1 << 40)


def usable(vector: str, scale: int) -> Column:
    v = F.col(f"`{vector}`")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < F.lit(LARGEST)))
    return F.coalesce((F.size(v) > 0) & sound, F.lit(False))


def whole(column: pa.Array, scale: int, shift: int) -> np.ndarray:
    """Rows of whole numbers from an Arrow list column of one length."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(scale * values) + shift).astype(np.int64).reshape(len(column), -1)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def sums(vectors: DataFrame, scale: int, shift: int) -> tuple[int, list[int]]:
    """How many vectors there are, and the sum of each dimension: one row of sums a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in slices(batches):
            x = whole(batch.column(0), scale, shift)
            n, total = n + len(x), x.sum(axis=0) if total is None else total + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(total)), pa.array(range(len(total))), pa.array(total)], ["n", "place", "total"])

    parts = vectors.mapInArrow(run, "n long, place long, total long")
    # A row a dimension; sums as decimals, which can't overflow.
    found = parts.groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("place").collect()
    return (int(found[0].n), [int(r.total) for r in found]) if found else (0, [])


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S exactly, as whole numbers of 64 bits where these suffice and of any size otherwise."""
    bound = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, total)))
    kind = np.int64 if bound < 1 << 61 else object
    return x.astype(kind) * n - np.array(total, dtype=kind)


def factor(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of the rows, square whatever their number."""
    d = rows.shape[1]
    return np.linalg.qr(np.vstack([rows, np.zeros((max(0, d - len(rows)), d))]) if len(rows) < d else rows, mode="r")


def compressed(vectors: DataFrame, n: int, total: list[int], scale: int, shift: int) -> np.ndarray:
    """The triangular factor of all centred rows."""
    d = len(total)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in slices(batches):
            r = factor(np.vstack([r, (centred(whole(batch.column(0), scale, shift), n, total) / n).astype(np.float64)]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for raw in batch.column(0):
                r = factor(np.vstack([r, np.frombuffer(raw.as_py()).reshape(d, d)]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    factors = written(vectors.mapInArrow(fold, "r binary"), "whitening-factors")
    while (count := factors.count()) > MERGE:
        factors = written(factors.repartition(-(-count // MERGE)).mapInArrow(merge, "r binary"), "whitening-factors")
    parts = [np.frombuffer(r.r).reshape(d, d) for r in factors.collect()]  # MERGE at most
    return factor(np.vstack(parts))


def rotated(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(components as columns, singular values falling) of a square factor, by one-sided Jacobi rotations.

    Each sweep meets every pair of columns once, in rounds of disjoint pairs that are rotated together.
    """
    d = r.shape[1]
    size = d + d % 2
    a, v = np.zeros((len(r), size)), np.eye(size)
    a[:, :d] = r
    ring, eps = np.arange(size), np.finfo(float).eps
    for _ in range(SWEEPS):
        turned = False
        for _ in range(size - 1):
            p, q = ring[: size // 2], ring[size // 2 :][::-1]
            alpha, beta, gamma = (a[:, p] ** 2).sum(axis=0), (a[:, q] ** 2).sum(axis=0), (a[:, p] * a[:, q]).sum(axis=0)
            off = np.abs(gamma) > eps * np.sqrt(alpha * beta)
            if off.any():
                p, q, alpha, beta, gamma = p[off], q[off], alpha[off], beta[off], gamma[off]
                with np.errstate(over="ignore"):  # an angle too small to turn anything
                    zeta = (beta - alpha) / (2 * gamma)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                s = c * t
                turned = turned or bool(s.any())
                for m in (a, v):
                    m[:, p], m[:, q] = c * m[:, p] - s * m[:, q], s * m[:, p] + c * m[:, q]
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if not turned:
            break
    lengths = np.sqrt((a**2).sum(axis=0))
    order = np.argsort(-lengths[:d] if size == d else -np.where(np.arange(size) < d, lengths, -1.0), kind="stable")[:d]
    return v[:d, order], lengths[order]


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row for each usable vector and component: the table's other columns, component, n, deviation,
    deviation_exact, whitened, explained and identity_error; see the module."""
    new = ["component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"]
    kept = [F.col(f"`{c}`") for c in others(df, [*new, vector])]
    rows = df.where(usable(vector, scale)).select(F.struct(*kept).alias("rest"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    vectors = rows.where(F.size("v") == (most.d if most else 0))
    n, total = sums(vectors.select("v"), scale, shift)
    if n:
        axes, lengths_of = rotated(compressed(vectors.select("v"), n, total, scale, shift))
        spread = lengths_of > LEAST * len(total) * max(lengths_of.max(), 1.0)
        used = int(min(components, spread.sum()))
    else:
        axes, lengths_of, used = np.zeros((0, 0)), np.zeros(0), 0
    ways, deviations = axes[:, :used], lengths_of[:used] / np.sqrt(max(n, 1))
    kind = T.StructType([*vectors.select("rest").schema.fields, T.StructField("exact", T.StringType()), T.StructField("w", T.ArrayType(T.DoubleType()))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            y = centred(whole(batch.column(1), scale, shift), n, total)
            wide = y.dtype == object or len(total) * int(np.abs(y).max(initial=0)) ** 2 >= 1 << 62
            squares = ((y.astype(object) if wide else y) ** 2).sum(axis=1)
            w = (y / n).astype(np.float64) @ ways / deviations
            offsets = pa.array(np.arange(0, len(w) * used + 1, used, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([str(s) for s in squares.tolist()]), lists], kind.names)

    if used:
        done = written(vectors.mapInArrow(project, kind), "whitening")
    else:
        done = df.sparkSession.createDataFrame([], kind)
    error = 0.0
    if used:
        at = lambda i: F.get("w", F.lit(i))
        places = [(i, j) for i in range(used) for j in range(i + 1)]
        shared = done.agg(*[F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in places]).first()
        error = max(abs(shared[f"c{i}_{j}"] - (i == j)) for i, j in places)
    parts = (lengths_of[:used] ** 2 / max((lengths_of**2).sum(), np.finfo(float).tiny)).tolist()
    return done.select("rest", "exact", F.posexplode("w").alias("place", "whitened")).select(
        "rest.*", (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), F.col("exact").try_cast("long").alias("deviation"), F.col("exact").try_cast("decimal(38,0)").alias("deviation_exact"),
        "whitened", F.get(F.lit(parts or [0.0]), F.col("place")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
