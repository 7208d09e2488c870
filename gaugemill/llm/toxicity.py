"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A feature is a hashed n-gram of the lower-cased text, counted once a document. Its scale is the
log of the ratio of its smoothed shares in toxic and in clean documents; a logistic regression
over the scaled features, fitted with L2 penalty, gives the score.

Fitting takes a bounded sample of the labelled rows (``sample_toxic``, ``sample_clean``), chosen
by a hash of the identifier; weights restore the shares that the classes have among all labelled
rows. Counts are gathered by Spark in slices of the feature space; the driver sees the bounded
number of selected features and their places in the sample, never texts.

Edge cases: null and empty texts have no features and get the score of the bias; labels that are
null or neither 0 nor 1 are left out; a document with several labels counts as toxic if any says
so; of texts that share an identifier the one with the smallest hash is learnt from; with no labels
of one class the score is the share of toxic ones, 0 without labels; columns of the results' names
are replaced; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import adding, sliced, written

ORDERS = (3, 4, 5)
BITS = 21
SLICE = 1 << 15
#: Fitting uses at most so many toxic and clean rows, and so many features.
SAMPLE_TOXIC, SAMPLE_CLEAN, FEATURES = 4_000, 8_000, 8_000
#: Tasks that count features of the sample.
COUNTERS = 12


class Grams:
    """The distinct features of a text."""

    def __init__(self, orders: tuple[int, ...] = ORDERS):
        self.orders = orders
        self.seen = np.zeros(1 << BITS, np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        points = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le"), np.uint32)
        h, found, n = points, [], 1
        for order in self.orders:
            while n < order and len(h) > 1:
                h = h[:-1] * np.uint32(0x01000193) + points[n:]
                n += 1
            if n < order or len(points) <= 2:
                break
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * order)
            found.append(mixed >> np.uint32(32 - BITS))
        if not found:
            return np.zeros(0, np.uint32)
        ids = np.concatenate(found)
        places = np.arange(len(ids), dtype=np.int32)
        self.seen[ids] = places  # the last place of each feature stays
        return ids[self.seen[ids] == places]


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.features] = self.weights
        return table


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, toxic: int, clean: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """(y, text) of the sampled rows, and for each class how many were labelled and taken."""
    y = F.col(f"`{label}`").cast("int")
    known = labels.where(F.col(f"`{key}`").isNotNull() & y.isin(0, 1)).groupBy(F.col(f"`{key}`").alias("key")).agg(F.max(y).alias("y"))
    known = written(known, "labels")
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col("key").cast("string"))
    parts = [known.where(F.col("y") == c).orderBy(order, "key").limit(most) for c, most in ((1, toxic), (0, clean))]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # bounded by the two limits
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(chosen, "key")
    # One text for each identifier, however many rows share it: the bound holds for rows as well.
    rows = rows.groupBy("key").agg(F.first("y").alias("y"), F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text"))
    # By the identifier too, so that a text which many rows share is spread.
    rows = written(rows.repartition(COUNTERS, F.xxhash64("key", "text")).select("y", "text"), "sample")
    taken = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    return rows, {c: (counts.get(c, 0), taken.get(c, 0)) for c in (0, 1)}


def count_features(rows: DataFrame, totals: dict[int, int], least: int = 3) -> DataFrame:
    """(feature, ratio, strength) of every feature in at least ``least`` sampled documents."""

    def count(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, table = Grams(), np.zeros((2, 1 << BITS), np.int32)
        for batch in sliced(of):
            for y, text in zip(*(c.to_pylist() for c in batch.columns)):
                table[y][grams(text)] += 1
        for i in range(0, 1 << BITS, SLICE):
            part = table[:, i : i + SLICE]
            if part.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "counts": pa.array([part.tobytes()], pa.binary())})

    def combine(part: pa.Table) -> pa.Table:
        base, sums = part["slice"][0].as_py(), np.zeros((2, SLICE), np.int64)
        for raw in part["counts"].to_pylist():
            sums += np.frombuffer(raw, np.int32).reshape(2, SLICE)
        at = np.flatnonzero(sums.sum(0) >= least)
        share = [(sums[c][at] + 0.5) / (totals[c] + 1.0) for c in (0, 1)]
        ratio = np.log(share[1] / share[0])
        # How far the toxic count lies from what chance would give.
        expected = sums[:, at].sum(0) * (totals[1] / (totals[0] + totals[1]))
        strength = np.abs(sums[1][at] - expected) / np.sqrt(expected + 1.0)
        return pa.table({"feature": pa.array(at + base, pa.int32()), "ratio": ratio, "strength": strength})

    slices = rows.select("y", "text").mapInArrow(count, "slice int, counts binary")
    return slices.groupBy("slice").applyInArrow(combine, "feature int, ratio double, strength double")


def logistic(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, scale: np.ndarray, penalty: float = 1.0, steps: int = 120) -> tuple[np.ndarray, float]:
    """Weights on the scaled features and the bias, by accelerated gradient descent."""
    place = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    value = scale.astype(np.float32)[place]
    w, b, n = np.zeros(len(scale)), 0.0, len(rows)
    share = np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)
    b = float(np.log(share / (1 - share)))
    squares = np.bincount(owner, value**2, n)
    # A step for each coordinate, from a bound of the curvature there.
    curve = np.bincount(place, 0.25 * weight[owner] * np.abs(value) * np.bincount(owner, np.abs(value), n)[owner], len(scale)) + penalty
    curve_b = 0.25 * weight.sum() * (1 + float(np.sqrt(squares).mean()))
    old_w, old_b, momentum = w, b, 1.0
    for _ in range(steps):
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = (momentum - 1) / following
        at_w, at_b, momentum = w + push * (w - old_w), b + push * (b - old_b), following
        z = np.bincount(owner, value * at_w[place], n) + at_b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        old_w, old_b = w, b
        w = at_w - (np.bincount(place, value * error[owner], len(scale)) + penalty * at_w) / curve
        b = at_b - float(error.sum()) / curve_b
    return w, b


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN, features: int = FEATURES) -> Model:
    """A model from the labels that are given; see the module for the sample's bound."""
    rows, counts = sample(docs, labels, key, text, label, sample_toxic, sample_clean)
    totals = {c: n for c, (_, n) in counts.items()}
    if not totals[0] or not totals[1]:
        known = counts[0][0] + counts[1][0]
        share = min(max(counts[1][0] / known if known else 0.0, 1e-12), 1 - 1e-12)
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), float(np.log(share / (1 - share))))
    best = count_features(rows, totals).orderBy(F.desc("strength"), "feature").limit(features).collect()
    chosen = np.array(sorted((r.feature, r.ratio) for r in best)).reshape(-1, 2)
    names, scale = chosen[:, 0].astype(np.int64), chosen[:, 1]

    def places(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, place = Grams(), np.full(1 << BITS, -1, np.int32)
        place[names] = np.arange(len(names))
        for batch in sliced(of):
            own = [place[grams(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.sort(x[x >= 0]).tobytes() for x in own], pa.binary())], ["y", "places"])

    # Bounded: the sample's rows, each with selected features only.
    got = sorted((r.y, bytes(r.places)) for r in rows.select("y", "text").mapInArrow(places, "y int, places binary").collect())
    y = np.array([r[0] for r in got], float)
    weight = np.where(y == 1, counts[1][0] / totals[1], counts[0][0] / totals[0])
    w, b = logistic([np.frombuffer(r[1], np.int32) for r in got], y, weight / weight.mean(), scale)
    return Model(names, (w * scale).astype(np.float32), b)


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score", keep_text: bool = True) -> DataFrame:
    """Adds the score, from 0 to 1, of every whole text."""

    def make():
        grams, table, bias = Grams(), model.dense(), model.bias

        def use(texts):
            z = np.array([bias + float(table[grams(t)].sum(dtype=np.float64)) for t in texts])
            return [1 / (1 + np.exp(-np.clip(z, -40, 40)))]

        return use

    return adding(df, [text], {to: T.DoubleType()}, make, () if keep_text else (text,))
