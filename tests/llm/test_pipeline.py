"""The pipeline's stages, each against its operator's rule."""

import collections
import re

import corpus_pipeline
import numpy as np
from gaugemill.llm import near, queries, secrets, toxicity
from pyspark.sql import functions as F
from test_operators import ASSIGN, brute_links, plain_schedule

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = queries.table(spark, FOLDER, "documents")
    columns = docs.columns
    known = {r.doc_id: r.text for r in docs.collect()}
    labels = queries.table(spark, FOLDER, "labels").where(~queries.held_out())
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    clean = stages["toxicity"](spark, docs, FOLDER).cache()
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {d for d, s in scores.items() if s < 0.3}
    single = stages["near_duplicates"](spark, clean, FOLDER).cache()
    label, _ = brute_links({r.doc_id: r.text for r in clean.collect()})
    assert single.columns == columns and {r.doc_id for r in single.collect()} == set(label.values())
    safe = stages["secrets"](spark, single, FOLDER).cache()
    assert safe.columns == columns
    scan = secrets.Scanner(words=queries.vocabulary(queries.SECRETS_WORDS))
    for r in safe.collect():
        assert r.n_chars == len(r.text) and (r.text == known[r.doc_id]) == (not scan(known[r.doc_id]))
        assert not re.search("AKIA[A-Z0-9]{16}|[0-9a-f]{24}", r.text)
    laid = stages["mixing"](spark, safe, FOLDER).cache()
    assert laid.columns == columns and sorted(r.doc_id for r in laid.collect()) == sorted(r.doc_id for r in safe.collect())
    last = stages["tokens"](spark, laid, FOLDER).collect()
    assert len(last) == laid.count() and all(r.round_trip for r in last)


def test_whole_run_by_brute_force(spark):
    """Every row of the result: which documents are left, in which places, and with which ids."""
    docs = queries.table(spark, FOLDER, "documents")
    model = toxicity.fit(docs, queries.table(spark, FOLDER, "labels").where(~queries.held_out()))
    clean = {r.doc_id: r for r in toxicity.score(docs, model).where("score < 0.3").collect()}
    label, _ = brute_links({d: r.text or "" for d, r in clean.items()})
    scan, left = secrets.Scanner(words=queries.vocabulary(queries.SECRETS_WORDS)), {}
    for d in sorted(set(label.values())):
        out, at, text = [], 0, clean[d].text or ""
        for a, k, b, _ in scan(text):
            a = re.match(ASSIGN, text[a:]).start(2) + a if k == 0 else a
            if b > at:
                out += [text[at:a], "[secret]"] if a >= at else []
                at = b
        left[d] = "".join(out) + text[at:]
    # Places: sources by the plain schedule, rows of a source by a hash of all their columns.
    rows = [(d, left[d], clean[d].lang, clean[d].source, len(left[d])) for d in left]
    table = spark.createDataFrame(rows, docs.schema)
    hashes = {r.doc_id: r.h % 2**64 for r in table.select("doc_id", F.xxhash64(F.lit(0), "doc_id", "text", "lang", "source", "n_chars").alias("h")).collect()}
    counts = collections.Counter(r[3] for r in rows)
    names = sorted(counts, key=lambda s: (s is not None, s or ""))
    own = {s: iter(sorted((r[0] for r in rows if r[3] == s), key=lambda d: hashes[d])) for s in names}
    order = []
    for _, i, j in plain_schedule([(counts[s] / max(counts.values())) ** 0.5 for s in names], [-(-counts[s] // 16) for s in names]):
        order += [d for _, d in zip(range(16), own[names[i]])]
    import base64

    import public_tokenizers as public
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted(corpus_pipeline.run(spark, FOLDER).collect(), key=lambda r: r.mix_position)
    assert [(r.mix_position, r.doc_id) for r in got] == list(enumerate(order)) and len(order) == len(left)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(left[r.doc_id]) and r.n_tokens == len(ids) and r.round_trip and r.source == clean[r.doc_id].source


def test_places_reach_the_result(spark):
    """Prefixes of the rows, by their place, follow the weights, though a scan packs files by size."""
    docs = spark.createDataFrame([(i, "en", "abc"[(i % 7 > 3) + (i % 7 > 5)], f"text {i} " * (1 + i % 50)) for i in range(2000)], "doc_id long, lang string, source string, text string")
    laid = corpus_pipeline.lay_out(spark, docs, FOLDER)
    want = {r.doc_id: r.mix_position for r in corpus_pipeline.mixing.mix(docs).collect()}
    for table in (corpus_pipeline.written(laid, "mixing"), laid):
        rows = sorted(corpus_pipeline.tokens(spark, table, FOLDER).collect(), key=lambda r: r.mix_position)
        assert {r.doc_id: r.mix_position for r in rows} == want and [r.mix_position for r in rows] == list(range(2000))
    counts = {k: sum(r.source == k for r in rows) for k in "abc"}
    total, done = sum(n**0.5 for n in counts.values()), dict.fromkeys("abc", 0)
    for r in rows[: int(0.9 * min(n**0.5 * total for n in counts.values()))]:
        done[r.source] += 1
        assert all(abs(done[k] - n**0.5 / total * (r.mix_position + 1)) < 32 for k, n in counts.items())


def test_run_returns_places(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(r.mix_position for r in rows) == list(range(len(rows)))
    sources = [r.source for r in sorted(rows, key=lambda r: r.mix_position)]
    counts = {k: sources.count(k) for k in set(sources)}
    total = sum(n**0.5 for n in counts.values())
    first = int(min(n**0.5 * total for n in counts.values())) - 32  # the first source runs out later
    assert all(abs(sources[:first].count(k) - n**0.5 / total * first) < 32 for k, n in counts.items())


def test_empty_tables(spark):
    docs = queries.table(spark, FOLDER, "documents").limit(0)
    assert near.dedupe(docs).count() == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0, name
