"""Exact deduplication, the filter audit and whitening against brute force, on small tables and odd rows."""

import collections
import hashlib
import itertools
import re

import numpy as np
import pytest
from gaugemill.llm import audit, naming, queries, whitening
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
LONG = "abcdefghij" * 700
ODD = [
    (1, None, "en"), (2, "", None), (3, " \n\t\x0b", ""), (4, "one two", "en"), (9, "one  two", "en"), (5, "onetwo", "de"), (5, "onetwo", "de"), (5, "on e t w o", "de"), (5, "on e t w o", "de"),
    (None, "no id", "en"), (None, "noid", "en"), (None, "with", "en"), (8, "with", "en"), (6, LONG, "fr"), (7, LONG + " ", "fr"), (11, LONG + "x", "fr"), (12, "x" + LONG, "fr"), (13, LONG[:64], "fr"), (14, LONG[:128], "fr"),
    (15, "A" * 64 + "B" * 64 + "A" * 64, "xx"), (16, "A" * 64 + "B" * 64, "xx"), (17, "B" * 64 + "A" * 64, "xx"), (18, "日本 語 テキスト", "ja"), (19, "日本語 テキスト", "ja"), (20, "# " * 300, "en"), (21, "one two", "de"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, "mine", "x") for i, t, lang in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, keep_id string, rest string")


def brute_groups(rows):
    """Of each row: (doc_id, keep_id, group_size, text_sha256), and how many rows of each group stay."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for body, found in groups.items():
        out += [(i, min(found)[3], len(found), hashlib.sha256(body.encode()).hexdigest()) for *_, i in found]
    return out


def weak(block, seed):
    """Hashes of which the first seeds give many blocks the same."""
    return F.struct((F.crc32(block) % 3 if seed == 0 else F.crc32(block) % 5 if seed == 1 else F.xxhash64(block)).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


@pytest.mark.parametrize("block_bytes, hashed", [(4096, naming.spread), (64, weak)])
def test_naming_of_odd_rows(spark, odd, block_bytes, hashed):
    got = naming.dedupe(odd, block_bytes=block_bytes, hashed=hashed)
    assert got.columns == ["doc_id", "lang", "rest", "keep_id", "group_size", "kept", "text_sha256"]
    rows = got.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == sorted(brute_groups([x[:2] for x in ODD]), key=repr)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_naming_is_by_bytes(spark, odd):
    """No two blocks share the hash that sorts them, and places are without gaps."""
    bodies = odd.select(naming.normalised().alias("body"))
    distinct, seed = naming.told_apart(bodies, 64, weak)
    assert seed == 2
    names = sorted(r.name for r in naming.places(distinct).collect())
    want = {b[i : i + 64] for _, t, _ in ODD for b in [re.sub(r"[\x20\x09-\x0d]", "", t or "").encode()] for i in range(0, max(len(b), 1), 64)}
    assert names == list(range(len(want)))


def test_naming_of_nothing(spark, odd):
    assert naming.dedupe(odd.limit(0)).count() == 0


def brute_audit(docs, labels):
    firsts, good, toxic = {}, {r.doc_id for r in labels if r.quality == 1} - {None}, {r.doc_id for r in labels if r.toxic == 1} - {None}
    for i, t, _ in docs:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    cells = collections.Counter()
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and firsts[t] < i}
        left, key = True, lang or ""
        for order in map("".join, itertools.permutations("ABCDE")):
            left = True
            for step, f in enumerate(order, 1):
                at = (key, order, step)
                cells[*at, "removed"] += left and fails[f]
                cells[*at, "redundant"] += not left and fails[f]
                cells[*at, "unique_fails"] += fails[f] and sum(fails.values()) == 1
                cells[*at, "good_lost"] += left and fails[f] and i in good
                cells[*at, "toxic_lost"] += left and fails[f] and i in toxic
                cells[key, f, "shapley"] += left and fails[f]
                left = left and not fails[f]
                cells[*at, "kept"] += left
    return cells


def test_audit_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (9, 0, 0), (9, 1, 1), (9, None, 1), (None, 1, 1), (20, 1, 0), (777, 1, 1)], "doc_id long, quality int, toxic int")
    rows = audit.audit(odd.withColumn("good", F.lit("x")).withColumn("digest", F.lit("x")), labels).collect()
    want = brute_audit(ODD, labels.collect())
    assert len(rows) == 600 * len({lang or "" for *_, lang in ODD})
    for r in rows:
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            assert r[c] == want[r.part, r.filter_order, r.step, c], (r, c)
        assert r.shapley == want[r.part, r.filter_order[r.step - 1], "shapley"]


def test_audit_of_nothing(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(odd.limit(0), labels).count() == 0
    assert all(r.good_lost == 0 and r.toxic_lost == 0 for r in audit.audit(odd, labels).collect())


def brute_whitening(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    y = n * x - total
    values, axes = np.linalg.eigh((y / n).T @ (y / n) / n)
    first = np.argsort(-values)[:components]
    return n, [sum(int(v) ** 2 for v in row) for row in y], (y / n) @ axes[:, first] / np.sqrt(values[first]), values[first] / values.sum()


def compared_whitening(rows, vectors):
    n, deviations, whitened, explained = brute_whitening(list(vectors.values()))
    at = {v: i for i, v in enumerate(vectors)}
    signs = {}
    for r in rows:
        want = whitened[at[r.vec_id], r.component - 1]
        sign = signs.setdefault(r.component, 1 if abs(r.whitened - want) < 1e-6 else -1)
        assert abs(r.whitened - sign * want) < 1e-6 and r.n == n and r.deviation == r.deviation_exact == deviations[at[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening(spark):
    rows = whitening.whiten(queries.table(spark, FOLDER, "embeddings").repartition(20), key="vec_id")
    vectors = {r.vec_id: r.embedding for r in queries.table(spark, FOLDER, "embeddings").collect()}
    found = rows.collect()
    assert len(found) == 8 * len(vectors)
    compared_whitening(found, vectors)


def test_whitening_of_odd_rows(spark):
    nan, inf, rng = float("nan"), float("inf"), np.random.default_rng(3)
    good = {i: [float(v) for v in rng.normal(size=5) * [5, 3, 2, 1, 0]] for i in range(40)}
    good[40] = good[41] = good[7]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [nan] * 5, [inf] + [0.0] * 4, [1.0, 2.0], [1e30] * 5]
    rows = [(i, v, 1.5, i) for i, v in good.items()] + [(100 + i, v, 2.5, i) for i, v in enumerate(bad)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, Whitened double, label long")
    found = whitening.whiten(table)
    assert found.columns == ["vec_id", "label", "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"]
    found = found.collect()
    assert len(found) == 4 * len(good)  # the fifth dimension doesn't vary
    n, _, _, _ = brute_whitening(list(good.values()))
    compared_whitening([r for r in found if r.component <= 4], good)
    assert {r.n for r in found} == {n}
    assert whitening.whiten(table.limit(0)).count() == 0 and whitening.whiten(table.where("vec_id in (7, 40, 41)")).count() == 0
    assert {r.component for r in whitening.whiten(table.where("vec_id < 3")).collect()} == {1, 2}


def test_whitening_beyond_64_bits(spark):
    table = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(table, scale=1 << 37).collect()
    x = [i << 37 for i in range(4)]
    for r in rows:
        exact = (4 * x[r.vec_id] - sum(x)) ** 2
        assert int(r.deviation_exact) == exact and r.deviation == (exact if exact < 1 << 63 else None)


def test_rotations_on_random_factors():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 7, 8, 33):
        r = np.triu(rng.normal(size=(d, d)) * 10.0 ** rng.integers(-6, 6, size=d))
        axes, lengths = whitening.rotated(r)
        assert np.allclose(lengths, np.linalg.svd(r, compute_uv=False), rtol=1e-8) and np.allclose(axes.T @ axes, np.eye(d), atol=1e-12)
        assert np.allclose(np.linalg.norm(r @ axes, axis=0), lengths, rtol=1e-8)
