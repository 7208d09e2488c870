"""The queries of the training-data operators, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, mixing, naming, near, pii, quality, secrets, sstable, token_files, topk, toxicity, whitening

#: Id of the end-of-document token in byte_bpe_50k.json; op10's contract appends 0 instead.
END_OF_DOCUMENT = 50256
#: Whose words op6 takes for its dictionary.
SECRETS_WORDS = "byte_bpe_multi_50k.tiktoken"


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str = "doc_id"):
    """Rows from which no labels are learnt."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = toxicity.score(docs, model, keep_text=False)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = topk.top_k(rows, F.col("vec_id") % 20 == 0, k=20, scale=64)
    return found.select("query_id", "rank", "vec_id", "score")


OP2_SQL = """
WITH clean AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM clean q JOIN clean c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 20
"""


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    count = lambda kind: F.size(F.filter("pii", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = pii.joined(F.filter("pii", lambda s: s.base))
    return found.select("doc_id", *[count(k) for k in pii.KINDS[:4]], F.sha2(base, 256).alias("base_sha256"), pii.joined(F.col("pii")).alias("spans"), F.array_max(F.transform("pii", lambda s: s.score)).alias("max_score"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.coded(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), decoded="decoded")
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


# What op5's rules are, for its SQL.
OP5_STOP_WORDS = (
    "the be to of and that have with is in for on as are this it at by or an from "
    "der die das und ist zu den mit von auf ein eine im nicht sich des dem für "
    "le la les et de un une est en que qui dans pour sur au du "
    "el los las y en un una es que por con para del al se no su lo como"
).split()
OP5_MARKS = """.,;:!?"'()[]{}<>*_-`~/|\\…«»„“”‚‘’–—¡¿"""
OP5_RULES = (
    ("too_few_words", "n_words >= 20"), ("too_many_words", "n_words <= 1000000"), ("word_length", "mean_word_chars BETWEEN 2 AND 15"), ("symbols", "symbol_ratio <= 0.1"), ("stop_words", "stop_word_ratio >= 0.06"),
    ("repeated_lines", "dup_line_ratio <= 0.3"), ("open_lines", "ellipsis_line_ratio <= 0.3"), ("bullets", "bullet_line_ratio <= 0.9"), ("repeated_words", "repeat_word_ratio <= 0.3"),
)


def op5_sql() -> str:
    """The counts, and the rule table as conditions on them."""
    # The same list, marks and thresholds, written out: the oracle reads nothing of the module.
    stop = ", ".join(f"'{w}'" for w in OP5_STOP_WORDS)
    marks = "'" + OP5_MARKS.replace("'", "''") + "'"
    parts = [f"CASE WHEN NOT ({condition}) THEN '{name}' END" for name, condition in OP5_RULES]
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^ 	-
]+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines FROM d
), tok AS (
  SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), win AS (
  SELECT rid, i, string_agg(word, ' ') OVER eight AS g, lead(word, 7) OVER (PARTITION BY rid ORDER BY i) AS last
  FROM tok WINDOW eight AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win WHERE last IS NOT NULL) WHERE c > 1
), covered AS (
  SELECT rid, sum(least({quality.WINDOW}, i - coalesce(before, i - {quality.WINDOW})))::BIGINT AS n
  FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM again) GROUP BY rid
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(list_filter(words, lambda x: lower(trim(x, {marks})) IN ({stop})))::BIGINT AS n_stop_words, len(lines) AS n_lines,
    len(list_filter(lines, lambda x: x.ends_with('...') OR x.ends_with('…'))) AS n_open,
    len(list_filter(lines, lambda x: substr(x, 1, 2) IN ('- ', '* ', '• '))) AS n_bullets
  FROM w LEFT JOIN covered USING (rid)
), r AS (
  SELECT *, coalesce(word_chars / nullif(n_words, 0)::DOUBLE, 0) AS mean_word_chars, coalesce(n_symbols / nullif(n_words, 0)::DOUBLE, 0) AS symbol_ratio,
    coalesce(n_stop_words / nullif(n_words, 0)::DOUBLE, 0) AS stop_word_ratio,
    coalesce(n_dup_lines / nullif(n_lines, 0)::DOUBLE, 0) AS dup_line_ratio, coalesce(n_open / nullif(n_lines, 0)::DOUBLE, 0) AS ellipsis_line_ratio,
    coalesce(n_bullets / nullif(n_lines, 0)::DOUBLE, 0) AS bullet_line_ratio, coalesce(n_repeat_words / nullif(n_words, 0)::DOUBLE, 0) AS repeat_word_ratio
  FROM m
), j AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, array_to_string(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL), ',') AS failed_rules FROM r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM j
"""


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False, words=vocabulary(SECRETS_WORDS))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = pii.joined(F.filter("secrets", lambda s: s.kind != secrets.KINDS[3]))
    return found.select("doc_id", *[count(k) for k in secrets.KINDS[:3]], F.sha2(base, 256).alias("base_sha256"), pii.joined(F.col("secrets")).alias("spans"), F.coalesce(F.array_max(F.transform("secrets", lambda s: s.log10_guesses)), F.lit(0.0)).alias("max_log10_guesses"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.link(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "copy_id", "n_links")


#: All pairs of different texts that share a shingle, their components, and the links of each text.
OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), c AS (
  SELECT row_number() OVER () AS cid, t, min(doc_id) AS copy_id, count(*) AS copies FROM d WHERE doc_id IS NOT NULL GROUP BY t
), w AS (
  SELECT cid, regexp_extract_all(lower(t), '[^\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+') AS words FROM c
), tok AS (
  SELECT cid, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), win AS (
  SELECT cid, n, i, string_agg(word, ' ') OVER (PARTITION BY cid ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g FROM tok
), s AS (
  SELECT DISTINCT cid, g FROM win WHERE i <= greatest(n - 4, 1)
), sizes AS (
  SELECT cid, count(*) AS n FROM s GROUP BY cid
), common AS (
  SELECT a.cid AS a, b.cid AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.cid <> b.cid GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.cid JOIN sizes y ON b = y.cid WHERE k >= 0.8 * (x.n + y.n - k) - 1e-9
), reach AS (
  SELECT cid AS a, cid AS b FROM c UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), class AS (
  SELECT reach.a AS cid, min(c.copy_id) AS class_id FROM reach JOIN c ON reach.b = c.cid GROUP BY 1
), linked AS (
  SELECT a AS cid, sum(copies)::BIGINT AS n FROM link JOIN c ON b = c.cid GROUP BY 1
)
SELECT doc_id, class_id, CASE WHEN doc_id IS NOT NULL THEN copy_id END AS copy_id, CASE WHEN doc_id IS NULL THEN 0 ELSE copies - 1 + coalesce(n, 0) END::BIGINT AS n_links
FROM d LEFT JOIN c ON d.t = c.t AND doc_id IS NOT NULL LEFT JOIN class USING (cid) LEFT JOIN linked USING (cid)
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    encode = sstable.library_encoder(vocabulary("byte_bpe_50k.json"), plain=True)  # the separator may stand in no text
    folder = token_files.write_flat(table(spark, sf_dir, "documents"), encode, END_OF_DOCUMENT)
    counts = token_files.token_counts(spark, folder, END_OF_DOCUMENT)
    order = spark.read.parquet(f"{folder}/order")
    # Both sides have all documents and compress well, so neither may be broadcast by its file size.
    return order.join(counts.hint("merge"), ["file", "ordinal"]).select(F.col("key").alias("doc_id"), "n_tokens")


def op10_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    encode = sstable.library_encoder(vocabulary("byte_bpe_50k.json"))
    folder = sstable.write_shards(table(spark, sf_dir, "documents"), encode, end_id=0)
    return sstable.read_shards(spark, folder).select(F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op11_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = naming.dedupe(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), n AS (
  SELECT rid, doc_id, length(t) AS chars, regexp_replace(t, '[\x20\x09-\x0D]', '', 'g') AS body FROM d
), r AS (
  SELECT *, row_number() OVER g AS place, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
  FROM n WINDOW g AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST, rid)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM r
"""


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return audit.audit(docs, table(spark, sf_dir, "labels"))


#: Every document counted at every step of every order.
OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS first FROM d GROUP BY t
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), w AS (
  SELECT d.doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, first FROM d JOIN firsts USING (t)
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    [CASE WHEN len(words) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
     CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' END,
     CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN w.doc_id > first THEN 'E' END] AS fails
  FROM w LEFT JOIN known USING (doc_id)
), c AS (
  SELECT part, list_filter(fails, lambda x: x IS NOT NULL) AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, s::INTEGER AS step, substr(filter_order, s, 1) AS filter, string_split(substr(filter_order, 1, s - 1), '') AS before FROM orders, range(1, 6) r(s)
), counted AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (NOT list_has_any(fails, before) AND NOT list_contains(fails, filter)), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, filter)), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (list_has_any(fails, before) AND list_contains(fails, filter)), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = [filter]), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, filter)), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, filter)), 0)::BIGINT AS toxic_lost
  FROM c, steps GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM counted
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_topk": op2_topk,
    "op3_pii": op3_pii,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_secrets": op6_secrets,
    "op7_ngram_join": op7_ngram_join,
    "op8_mixing": op8_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_sstable": op10_sstable,
    "op11_naming": op11_naming,
    "op12_audit": op12_audit,
    "op13_whitening": op13_whitening,
}
ORACLES: dict[str, str] = {"op2_topk": OP2_SQL, "op5_quality": op5_sql(), "op7_ngram_join": OP7_SQL, "op11_naming": OP11_SQL, "op12_audit": OP12_SQL}
