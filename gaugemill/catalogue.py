"""The registered queries over the driver's tables, and the same in SQL.

Replies and verdicts are arithmetic over identifiers, so that both engines can compute them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import parse, template
from .functions.contract import build_prompt, read_contract
from .functions.scalars import duration, row_key, seeded, status_class
from .operators import log, sampling, summary
from .plans import plan as plans
from .plans.backends import RuleBackend, ask
from .plans.judge import Options, judge, planned, recorded
from .sources import items as sources
from .sources.config import Endpoint, pool_sizes, spec_of
from .sources.sinks import scratch
from .streaming import streams

VALUES = ["consistent", "inconsistent", "unsure"]
CONTRACT = read_contract('{"verdict": "consistent" | "inconsistent" | "unsure", "short_reason": "<why>"}')


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def verdict(number):
    """A verdict from a number: of seven, three are consistent, two inconsistent, one unsure, one none."""
    return F.when(number % 7 == 0, F.lit(None)).when(number % 7 <= 3, "consistent").when(number % 7 <= 5, "inconsistent").otherwise("unsure")


VERDICT_SQL = "CASE WHEN {n} % 7 = 0 THEN NULL WHEN {n} % 7 <= 3 THEN 'consistent' WHEN {n} % 7 <= 5 THEN 'inconsistent' ELSE 'unsure' END"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    error = F.when(n % 11 == 0, "length").when(n % 13 == 0, "timeout")
    return table(spark, sf_dir, "documents").select(
        n.alias("seq"), n.cast("string").alias("id"), F.when(n % 10 == 0, "").otherwise(F.col("lang")).alias("group"), F.col("source").alias("stratum"),
        (n % 4 * 0.5).alias("weight"), F.get(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (n % 3).cast("int")).alias("endpoint"), F.when(n % 2 == 0, "m1").otherwise("m2").alias("model"),
        verdict(n).alias("verdict"), F.when(n % 7 != 0, F.lit("{}")).alias("answer_json"), F.when(n % 17 == 0, "not JSON").alias("parse_error"), F.struct(error.alias("class")).alias("error"),
        F.when(n % 5 == 0, F.lit(None)).otherwise(n % 19 != 0).alias("key_order_ok"), F.when(n % 23 == 0, "so").otherwise("").alias("reasoning"), F.when(n % 29 == 0, parse.UNCLOSED).alias("parse_note"),
        (n * 37 % 1000 / 100).alias("latency_s"), F.when(n % 6 != 0, n * 7 % 64).alias("completion_tokens"), F.col("n_chars").alias("prompt_tokens"), F.when(n % 7 != 0, "short").alias("short_reason"),
    )


RESULTS_SQL = f"""results AS (SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 10 = 0 THEN 'all' ELSE lang END AS grp, source AS stratum,
  CASE WHEN doc_id % 4 = 0 THEN 1.0::DOUBLE ELSE (doc_id % 4) * 0.5::DOUBLE END AS w, CASE doc_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS endpoint,
  CASE WHEN doc_id % 2 = 0 THEN 'm1' ELSE 'm2' END AS model, {VERDICT_SQL.format(n="doc_id")} AS verdict, doc_id % 7 <> 0 AS judged, (doc_id * 37 % 1000)::DOUBLE / 100::DOUBLE AS latency_s,
  CASE WHEN doc_id % 6 <> 0 THEN doc_id * 7 % 64 END AS completion_tokens, n_chars AS prompt_tokens, doc_id FROM documents)"""


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document at three endpoints."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "doc_id")
    endpoints = spark.createDataFrame([("a", "m"), ("b", "m"), ("c", "m")], "endpoint string, model string")
    return plans.compare_plan(docs, endpoints).withColumn("verdict", verdict(F.col("doc_id") * (F.ascii("endpoint") - 96)))


COMPARED_SQL = f"""compared AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, endpoint, {VERDICT_SQL.format(n="(doc_id * k)")} AS verdict
  FROM documents CROSS JOIN (VALUES ('a', 1), ('b', 2), ('c', 3)) AS e(endpoint, k))"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three records of each document, some with errors."""
    n = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("a")).where((n + F.col("a")) % 5 != 0)
    return rows.select(n.cast("string").alias("key"), (F.col("a") * 1_000_000 + n).cast("long").alias("seq"), verdict(n + F.col("a")).alias("verdict"), F.struct(F.when((n + F.col("a")) % 4 == 0, "timeout").alias("class")).alias("error"))


ATTEMPTS_SQL = f"""attempts AS (SELECT CAST(doc_id AS VARCHAR) AS key, a * 1000000 + doc_id AS seq, {VERDICT_SQL.format(n="(doc_id + a)")} AS verdict, CASE WHEN (doc_id + a) % 4 = 0 THEN 'timeout' END AS error_class
  FROM documents CROSS JOIN (VALUES (0), (1), (2)) AS x(a) WHERE (doc_id + a) % 5 <> 0),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS r FROM attempts) WHERE r = 1)"""


def docs_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.lit("all").alias("group"), F.concat("lang", F.lit("/"), "source").alias("stratum"))


STRATA_SQL = "strata AS (SELECT doc_id AS pos, 'all' AS grp, lang || '/' || source AS stratum FROM documents), counts AS (SELECT stratum, count(*) AS eligible FROM strata GROUP BY stratum)"
PROPORTIONAL_SQL = f"""WITH {STRATA_SQL}, t AS (SELECT CAST(sum(eligible) AS BIGINT) AS total FROM counts),
shares AS (SELECT stratum, eligible, 137 * eligible // total AS lo, 137 * eligible % total AS rest FROM counts CROSS JOIN t),
ranked AS (SELECT *, row_number() OVER (ORDER BY rest DESC, stratum) AS r, CAST(sum(lo) OVER () AS BIGINT) AS s FROM shares),
taken AS (SELECT stratum, eligible, lo + CASE WHEN r <= 137 - s THEN 1 ELSE 0 END AS take FROM ranked)"""
EQUAL_SQL = f"""WITH {STRATA_SQL}, rows_ranked AS (SELECT stratum, row_number() OVER (PARTITION BY stratum ORDER BY pos) AS r FROM strata),
first AS (SELECT stratum, row_number() OVER (ORDER BY r, stratum) AS o FROM rows_ranked)
SELECT c.stratum AS stratum, eligible, CAST(count(o) AS BIGINT) AS take FROM counts c LEFT JOIN (SELECT * FROM first WHERE o <= 137) f ON c.stratum = f.stratum GROUP BY c.stratum, eligible"""


def allocated(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return sampling.allocate(sampling.stratum_counts(strata(spark, sf_dir)), F.lit(137), F.lit(kind))


def sample_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = sampling.draw(strata(spark, sf_dir), allocated(spark, sf_dir, "proportional"))
    return drawn.select(F.concat(F.lit("documents:"), "pos").alias("id"), "stratum", "weight")


def weighted_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample, weigh, judge by rule, keep the latest record, and take the rates by language."""
    drawn = sampling.draw(strata(spark, sf_dir), allocated(spark, sf_dir, "proportional"))
    judged = drawn.select(F.col("pos").cast("string").alias("key"), F.col("pos").alias("seq"), F.split("stratum", "/")[0].alias("group"), "weight", verdict(F.col("pos")).alias("verdict"), F.when(F.col("pos") % 7 != 0, "{}").alias("answer_json"))
    return summary.rates(log.latest(judged), VALUES)


RATES_SQL = """, cells AS (SELECT g.grp, v.verdict FROM (SELECT DISTINCT grp FROM results) g CROSS JOIN (VALUES ('consistent'), ('inconsistent'), ('unsure')) AS v(verdict)),
whole AS (SELECT grp, count(*) AS judged, sum(w) AS w FROM results WHERE judged GROUP BY grp),
hits AS (SELECT grp, verdict, count(*) AS n, sum(w) AS w FROM results WHERE judged GROUP BY grp, verdict)
SELECT c.grp AS "group", c.verdict AS verdict, COALESCE(h.n, 0) AS "rows", COALESCE(t.judged, 0) AS judged, round(COALESCE(h.n, 0)::DOUBLE / greatest(1, COALESCE(t.judged, 0)), 4) AS rate,
  round(COALESCE(h.w, 0.0::DOUBLE) / COALESCE(t.w, 1.0::DOUBLE), 4) AS rate_weighted
FROM cells c LEFT JOIN whole t ON c.grp = t.grp LEFT JOIN hits h ON c.grp = h.grp AND c.verdict = h.verdict"""


def select_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic"))
    chosen = sampling.selection({"quality": ("1",), "toxic": ("0", "1")}, labels.columns)
    return table(spark, sf_dir, "documents").join(labels, "doc_id").where(chosen).groupBy("lang", "toxic").agg(F.count("*").alias("n"))


def stratum_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs_labels(spark, sf_dir)
    return rows.select("doc_id", template.label("{lang}/quality={quality}", {c: F.col(c) for c in rows.columns}).alias("stratum"))


def attrs_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    left = docs.select(F.col("doc_id").alias("pos"), F.struct("lang").alias("row"), F.lit(1).alias("in_rows"))
    right = labels.select(F.col("doc_id").alias("pos"), F.struct(F.col("doc_id").alias("index")).alias("attr"), F.lit(1).alias("in_attrs"))
    return sampling.mismatches(left.join(right, "pos", "full_outer"))


def validate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    pool = turns.select(F.col("conv_id").cast("string").alias("id"), F.lit("{}").alias("fields_json"), F.lit(1.0).alias("weight"))
    return sources.problems(pool).select("problem", "rows")


def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), F.col("props").alias("fields_json"), F.lit(1.0).alias("weight"))
    return sources.problems(pool, ["no_such_column"]).select("problem", "rows")


def pool_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a pool with every kind of fault: no JSON, no id, a list for fields, a weight in words, and so on."""
    n, k = F.col("doc_id").cast("string"), F.col("doc_id") % 10
    named = lambda rest, name=n: F.concat(F.lit('{"id": "'), name, F.lit('", '), F.lit(rest))
    bad = F.when(k == 0, F.concat(F.lit("not JSON "), n)).when(k == 1, named('"fields": {"x": 1}}', F.lit(""))).when(k == 2, named('"fields": [1]}')).when(k == 3, named('"weight": "heavy", "fields": {"x": 1}}'))
    line = bad.when(k == 4, named('"fields": {"y": 1}}')).when(k == 5, named('"fields": {"x": 2}}', F.lit("same"))).otherwise(named('"weight": 2, "fields": {"x": null}}'))
    lines = table(spark, sf_dir, "documents").select(line.alias("value"))
    return sources.problems(sources.json_items(lines, F.col("value")), ["x"]).select("problem", "rows")


def pool_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole pool by its spec: one group takes all that its languages have, the other a share."""
    groups = {"all": {"table": "documents", "select": {"lang": ["de", "fr"]}, "stratum": "{source}"}, "few": {"table": "documents", "select": {"lang": "en"}, "stratum": "{lang}", "alloc": "equal"}}
    spec = spec_of({"tables": {"documents": {"rows": "-"}}, "groups": groups, "sizes": {"pool": {"all": 0, "few": 9}}})
    docs = table(spark, sf_dir, "documents").select("lang", "source", F.col("n_chars").cast("string").alias("n_chars"))
    items = sampling.make_items(spark, spec, pool_sizes(spec, "pool"), tables={"documents": (docs, None)})
    return items.select("id", "group", "stratum", "weight", F.get_json_object("fields_json", "$.n_chars").alias("n_chars"))


def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("runs/"), F.col("doc_id")).alias("path")
    return streams.missing_files(table(spark, sf_dir, "documents").select(path), table(spark, sf_dir, "labels").select(path))


def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    text = template.render("Part {p_name} of {p_brand}, size {p_size}.", {c: F.col(c) for c in part.columns})
    return part.select("p_partkey", text.alias("user"))


def render_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs_labels(spark, sf_dir)
    values = {"lang": F.col("lang"), "quality": F.col("quality").cast("double")}
    return rows.select("doc_id", template.render("{lang}: {quality}", values).alias("user"))


def documents_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.send_order(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "doc_id"))


ORDER_SQL = "plan AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, row_number() OVER (ORDER BY sha256('42|order|' || CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR)) - 1 AS ord FROM documents)"


def part_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = documents_plan(spark, sf_dir)
    return plans.part_of(order, "2/7", F.lit(table(spark, sf_dir, "documents").count())).select("id", "ord")


def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))
    return docs.select("id", row_key(F.col("id"), F.lit("m"), "p", "s", F.lit("a")).alias("key"), row_key(F.col("id"), F.lit("m"), "p", None, F.lit("")).alias("shared_key"))


def keyed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "doc_id")


def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = keyed_documents(spark, sf_dir)
    return plans.remaining(plan, plan.where("doc_id % 3 = 0").select("key")).select("key")


def resume_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = keyed_documents(spark, sf_dir)
    return plans.already_done(plan, plan.where("doc_id % 3 = 0").select("key")).select("key")


def planned_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = keyed_documents(spark, sf_dir)
    return plans.planned_missing(plan, plan.where("doc_id % 3 = 0").select("key"))


def parts_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attempts(spark, sf_dir)
    one, two = rows.where("seq < 1500000"), rows.where("seq >= 500000")
    return log.latest(log.union_logs(one, two)).select("key", "verdict")


def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in (200, 401, 429, 524, 503, 404, 530, 500)])
    rows = table(spark, sf_dir, "events").select(status_class(F.get(codes, (F.col("event_id") % 8).cast("int"))).alias("class"))
    return summary.histogram(rows, F.col("class"), "class")


def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log.streaks(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return rows.groupBy("user_id").agg(F.max("streak").alias("longest"))


def first_n_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.first_all_failed(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type").isin("error", "view"), 3)


def trailing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log.trailing(table(spark, sf_dir, "events"), ["event_type"], F.unix_micros(F.col("ts").cast("timestamp")), F.lit(100))
    return rows.select("event_id", "last_60s", "last_300s", "eta_minutes")


def sse_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("seq"), F.col("text").alias("delta"), F.when(F.col("role") == "assistant", F.concat(F.lit("stop"), "turn")).alias("finish"))
    return log.assembled(chunks, ["conv_id"])


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good replies, a wrong label, a missing key, trailing text, and no JSON."""
    n = F.col("doc_id")
    good = F.concat(F.lit('{"verdict": " Consistent ", "short_reason": "r'), n, F.lit('"}'))
    bad = F.when(n % 5 == 1, '{"verdict": "maybe", "short_reason": "x"}').when(n % 5 == 2, '{"verdict": "unsure"}').when(n % 5 == 3, F.concat(good, F.lit(" tail"))).when(n % 5 == 4, "none")
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(bad, good).alias("content"))


def strict_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replies(spark, sf_dir).withColumn("p", parse.parsed(F.col("content"), CONTRACT))
    return rows.select("doc_id", "p.verdict", "p.short_reason", "p.key_order_ok", F.col("p.parse_error").isNotNull().alias("failed"))


def tolerant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("<unused94>think {}<unused95>I say "), F.col("content"))
    rows = replies(spark, sf_dir).withColumn("p", parse.parsed(text, CONTRACT, guided=False))
    return rows.select("doc_id", "p.verdict", "p.reasoning", F.col("p.parse_error").isNotNull().alias("failed"))


def thought_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    text = F.concat(F.lit("a<unused94>b"), F.when(n % 2 == 0, "<unused95>c").otherwise("d"), n.cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", parse.without_thoughts(text).alias("content"))


def crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.crosstab(results(spark, sf_dir))


def endpoint_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.by_endpoint(results(spark, sf_dir)).withColumn("models", F.array_join("models", ","))


def quantiles_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.counted_quantiles(results(spark, sf_dir), ("endpoint",), "latency_s", (50, 90))


def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sampling.stratum_counts(docs.select(F.col("lang").alias("group"), F.col("source").alias("stratum")))


def chat_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha"))
    return log.without_copies(docs, "sha")


def streaming_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.progress(table(spark, sf_dir, "events"), ["event_type"])


def superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same keys, both of which number their records from 0: the later run counts."""
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), (F.col("event_type") == "error").alias("is_error"), n.alias("n"))
    seq = F.floor((F.col("n") - 1) / 2).alias("seq")
    first, second = (rows.where(F.col("n") % 2 == run).select("key", "is_error", seq) for run in (0, 1))
    return log.latest(log.union_logs(first, second)).select("key", "is_error")


def run_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("file_name")).agg(F.count("*").alias("n"))
    return plans.budget(files, 0.2, 40)


PROMPT = build_prompt("parts", 'Judge the part. Answer\n{"verdict": "consistent" | "inconsistent" | "unsure", "short_reason": "<why>"}', "Part {p_name} of {p_brand}, size {p_size}.")
RULES = RuleBackend(rules=((("widget", "Brand#1"), "inconsistent"), (("bolt",), "unsure")), refuse="Brand#25,")
ENDPOINTS = [Endpoint("a", "m1", concurrency=2), Endpoint("b", "m2", concurrency=2)]


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of all parts."""
    fields = F.to_json(F.struct("p_name", "p_brand", "p_size"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), fields.alias("fields_json"), F.col("p_type").alias("group"), F.lit("").alias("stratum"), (1 + F.col("p_size") % 3).cast("double").alias("weight"))


def judged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts rendered, sent to two endpoints that answer by rules, parsed and recorded."""
    options = Options(mode="compare")
    replies = ask(planned(parts(spark, sf_dir), PROMPT, ENDPOINTS, options), PROMPT.system, PROMPT.contract, RULES, ENDPOINTS)
    return recorded(replies, PROMPT, options)


PARTS_SQL = f"""texts AS (SELECT *, CAST(p_partkey AS VARCHAR) AS id, 'Part ' || p_name || ' of ' || p_brand || ', size ' || CAST(p_size AS VARCHAR) || '.' AS t FROM part),
ruled AS (SELECT *, contains(t, 'Brand#25,') AS refused, CASE WHEN contains(t, 'widget') AND contains(t, 'Brand#1') THEN 'inconsistent' WHEN contains(t, 'bolt') THEN 'unsure' ELSE 'consistent' END AS v,
  row_number() OVER (ORDER BY sha256('42|order|' || id), id) - 1 AS ord FROM texts),
records AS (SELECT r.*, endpoint, model, substr(sha256(id || '|' || model || '|{PROMPT.sha}|{PROMPT.contract.schema_sha()}|' || endpoint), 1, 32) AS key FROM ruled r CROSS JOIN (VALUES ('a', 'm1'), ('b', 'm2')) AS e(endpoint, model))"""


def judge_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one table: the first 100 parts, some refused; then all, with errors sent again.

    Of each part its number of records, its last verdict, and whether the last record is an error.
    """
    out, items = scratch(spark, "judge-resume"), parts(spark, sf_dir)
    judge(items, out, PROMPT, ENDPOINTS[:1], RULES, Options(limit=100))
    every = judge(items, out, PROMPT, ENDPOINTS[:1], RuleBackend(rules=RULES.rules, refuse=""), Options(retry_errors=True))
    last = log.latest(every).select("id", "verdict", F.col("error").isNotNull().alias("failed"))
    return every.groupBy("id").agg(F.count("*").alias("records")).join(last, "id")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with blank, torn and glued lines, lines of other JSON, and records whose key comes twice."""
    n, k = F.col("doc_id").cast("string"), F.col("doc_id") % 8
    record = F.concat(F.lit('{"key": "'), n, F.lit('", "verdict": "x"}'))
    line = F.when(k == 0, F.lit(" \t")).when(k == 1, F.concat(F.lit('{"key": "'), n, F.lit('", "verdict": "x'))).when(k == 2, F.concat(record, record)).when(k == 3, F.concat(F.lit("["), record, F.lit("]")))
    line = line.when(k == 4, F.lit('{"verdict": "x"}')).when(k == 5, F.concat(F.lit('{"key": "old", "key": "'), n, F.lit('"}'))).when(k == 6, F.concat(record, F.lit(', "more": 1')))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), line.otherwise(record).alias("value"))


def part_name(number):
    """Files of unlike sizes, the smallest first: a tenth, three tenths, the rest."""
    return F.when(number % 10 == 0, "a").when(number % 10 <= 3, "b").otherwise("c")


def in_files(rows: DataFrame, kind: str, *order: str) -> str:
    """A folder of CSV or text files, in a folder for each ``part``, with their rows in order."""
    path = scratch(rows.sparkSession, f"{kind}-files")
    parts = max(4, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    laid = rows.repartitionByRange(parts, "part", *order).sortWithinPartitions("part", *order)
    laid = laid.select("value", "part") if kind == "text" else laid
    laid.write.partitionBy("part").format(kind).options(**({} if kind == "text" else {"header": True})).save(path)
    return path


def csv_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without identifiers from a folder of CSV files: each is named by its place in all files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", part_name(F.col("doc_id")).alias("part"))
    items = sources.csv_items(spark, in_files(docs, "csv", "doc_id"), breaks=False)
    return items.select("id", F.get_json_object("fields_json", "$.doc_id").alias("doc_id"), F.get_json_object("fields_json", "$.part").alias("part"))


def log_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of three runs as files of one folder, each longer than the one before; the last record of each key."""
    n = F.col("doc_id")
    runs = F.array_compact(F.array(F.when(n % 10 == 0, "1"), F.when(n % 3 == 0, "2"), F.when(n % 5 != 0, "3")))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(runs).alias("part"))
    line = F.concat(F.lit('{"key": "'), n, F.lit('", "run": '), F.col("part"), F.lit("}"))
    records, _ = sources.read_results(spark, in_files(rows.withColumn("value", line), "text", "doc_id"))
    return log.latest(records).select("key", "seq", F.get_json_object("value", "$.run").alias("run"))


def zip_folders(spark: SparkSession, sf_dir: str, whole: bool) -> DataFrame:
    """Rows and attributes from two folders of files, zipped; not ``whole``: some attributes are missing.

    Ranges are cut at places that a sample gives, and each shuffle takes a sample of its own. So rows are dealt
    once, and both folders are written by the ``piece`` that a row was dealt to.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", part_name(F.col("doc_id")).alias("part"))
    n, path = max(4, int(spark.conf.get("spark.sql.shuffle.partitions"))), scratch(spark, "dealt")
    dealt = docs.repartitionByRange(n, "part", "doc_id").withColumn("piece", F.lpad(F.spark_partition_id().cast("string"), 9, "0"))
    dealt.write.parquet(path)
    docs, paths = spark.read.schema(dealt.schema).parquet(path), []
    for side in (docs, docs if whole else docs.where("doc_id % 50 <> 1")):
        paths.append(scratch(spark, "zip-files"))
        side.repartition("part", "piece").sortWithinPartitions("part", "piece", "doc_id").write.partitionBy("part", "piece").csv(paths[-1], header=True)
    return sampling.zipped(*[sources.read_table(spark, path, breaks=False) for path in paths], by_file=whole)


def zip_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_folders(spark, sf_dir, True).select("pos", F.col("row.doc_id").alias("row_doc"), F.col("attr.doc_id").alias("attr_doc"))


def zip_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.mismatches(zip_folders(spark, sf_dir, False))


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", duration(F.col("event_id") * 7).alias("took"))


def planned_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("file_name")).agg(F.count("*").alias("n"))
    return plans.planned_total(files, 40)


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log.recent_events(table(spark, sf_dir, "events"), ["event_type"], "event_id", "user_id")
    return rows.select("event_type", F.array_join(F.transform("events", lambda x: x.cast("string")), ",").alias("events"))


PLACES_SQL = """parts AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'a' WHEN doc_id % 10 <= 3 THEN 'b' ELSE 'c' END AS part FROM documents),
places AS (SELECT *, row_number() OVER (ORDER BY part, doc_id) - 1 AS pos FROM parts)"""


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {
    "select_groups": select_groups,
    "stratum_label": stratum_label,
    "stratum_counts": group_counts,
    "alloc_proportional": lambda s, d: allocated(s, d, "proportional").select("stratum", "eligible", "take"),
    "alloc_equal": lambda s, d: allocated(s, d, "equal").select("stratum", "eligible", "take"),
    "sample_items": sample_items,
    "attrs_alignment": attrs_alignment,
    "validate_ids": validate_ids,
    "missing_fields": missing_fields,
    "pool_problems": pool_problems,
    "pool_items": pool_items,
    "missing_files": missing_files,
    "take_all": lambda s, d: sampling.allocate(sampling.stratum_counts(strata(s, d)), F.lit(0), F.lit("proportional")).select("stratum", "eligible", "take"),
    "render_prompt": render_prompt,
    "render_missing": render_missing,
    "send_order": lambda s, d: plans.first_in_order(table(s, d, "documents").select(F.col("doc_id").cast("string").alias("id")), 100).select("id", "ord"),
    "part_slices": part_slices,
    "row_keys": row_keys,
    "resume_anti": resume_anti,
    "resume_semi": resume_semi,
    "planned_missing": planned_missing,
    "planned_total": planned_total,
    "retry_errors": lambda s, d: plans.done_keys(attempts(s, d), retry_errors=True),
    "compare_plan": lambda s, d: compared(s, d).select("id", "endpoint", "verdict"),
    "agreement": lambda s, d: summary.agreement(compared(s, d)),
    "agreement_table": lambda s, d: summary.confusion(compared(s, d)),
    "latest_record": lambda s, d: log.latest(attempts(s, d)).select("key", "seq", "verdict"),
    "totals": lambda s, d: summary.totals(results(s, d)),
    "group_totals": lambda s, d: summary.by_group(results(s, d)),
    "verdict_rates": lambda s, d: summary.rates(results(s, d), VALUES),
    "weighted_rates": weighted_rates,
    "verdict_counts": lambda s, d: summary.verdicts(results(s, d)),
    "stratum_crosstab": crosstab,
    "endpoint_stats": endpoint_stats,
    "quantiles_list": quantiles_list,
    "quantiles_one": lambda s, d: summary.quantiles(results(s, d).withColumn("endpoint", F.lit("one")).withColumn("chars", F.col("prompt_tokens") * 1.7 + F.col("seq") / 1000), ("endpoint",), {"chars": (0, 1, 50, 90, 99, 100)}),
    "summary_cube": lambda s, d: summary.cube(results(s, d)).withColumn("weight", F.round("weight", 6)),
    "label_domain": lambda s, d: summary.label_domain(results(s, d)).select(F.array_join("values", ",").alias("values")),
    "parse_notes": lambda s, d: summary.histogram(results(s, d), F.col("parse_note"), "note"),
    "error_classes": error_classes,
    "failure_streaks": failure_streaks,
    "first_n_failed": first_n_failed,
    "trailing_rate": trailing_rate,
    "recent_events": recent,
    "sse_assembly": sse_assembly,
    "strict_parse": strict_parse,
    "tolerant_parse": tolerant_parse,
    "thought_strip": thought_strip,
    "join_back": lambda s, d: summary.join_back(table(s, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang"), results(s, d).where("verdict is not null")),
    "parts_union": parts_union,
    "chat_dedupe": chat_dedupe,
    "superseded": superseded,
    "endpoint_errors": lambda s, d: summary.endpoint_errors(results(s, d)),
    "run_budget": run_budget,
    "rule_judging": lambda s, d: judged_parts(s, d).select("key", "id", "endpoint", "model", "verdict", "short_reason", F.col("error.class").alias("error_class"), "prompt_tokens", "key_order_ok"),
    "judged_rates": lambda s, d: summary.rates(log.latest(judged_parts(s, d).where("endpoint = 'a'")), VALUES),
    "judge_resume": judge_resume,
    "log_records": lambda s, d: sources.usable(log_lines(s, d))[0].select("seq", "key"),
    "log_counts": lambda s, d: sources.usable(log_lines(s, d))[1],
    "csv_places": csv_places,
    "log_folder": log_folder,
    "zip_places": zip_places,
    "zip_refusals": zip_refusals,
    "durations": durations,
    "streaming_summary": streaming_summary,
}

ORACLES: dict[str, str] = {
    "select_groups": "SELECT lang, CAST(toxic AS VARCHAR) AS toxic, count(*) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1 GROUP BY lang, toxic",
    "stratum_label": "SELECT d.doc_id AS doc_id, lang || '/quality=' || COALESCE(CAST(quality AS VARCHAR), '') AS stratum FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "stratum_counts": 'SELECT lang AS "group", source AS stratum, count(*) AS eligible FROM documents GROUP BY lang, source',
    "alloc_proportional": f"{PROPORTIONAL_SQL} SELECT stratum, eligible, take FROM taken",
    "alloc_equal": EQUAL_SQL,
    "sample_items": f"""{PROPORTIONAL_SQL}, drawn AS (SELECT pos, stratum, row_number() OVER (PARTITION BY stratum ORDER BY sha256('42|all|' || stratum || '|' || CAST(pos AS VARCHAR)), pos) AS r FROM strata)
SELECT 'documents:' || CAST(pos AS VARCHAR) AS id, d.stratum AS stratum, round(eligible::DOUBLE / take, 6) AS weight FROM drawn d JOIN taken t ON d.stratum = t.stratum WHERE r <= take""",
    "attrs_alignment": "SELECT d.doc_id AS pos, 'no counterpart' AS problem FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL",
    "validate_ids": "SELECT 'id is repeated' AS problem, count(*) AS \"rows\" FROM (SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) > 1)",
    "missing_fields": "SELECT 'a placeholder''s column is missing' AS problem, count(*) AS \"rows\" FROM events",
    "pool_problems": """WITH k AS (SELECT doc_id % 10 AS k, count(*) AS n FROM documents GROUP BY k), p AS (
  SELECT 'id is empty' AS problem, sum(n) FILTER (k IN (0, 1)) AS c FROM k UNION ALL SELECT 'fields is no object', sum(n) FILTER (k IN (0, 2)) FROM k UNION ALL SELECT 'weight is no number', sum(n) FILTER (k = 3) FROM k
  UNION ALL SELECT 'a placeholder''s column is missing', sum(n) FILTER (k = 4) FROM k UNION ALL SELECT 'id is repeated', count(*) FILTER (k IN (0, 1, 5) AND n > 1) FROM k)
SELECT problem, CAST(c AS BIGINT) AS "rows" FROM p WHERE c > 0""",
    "pool_items": """WITH d AS (SELECT row_number() OVER () - 1 AS pos, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents),
few AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY sha256('42|few|' || lang || '|' || CAST(pos AS VARCHAR)), pos) AS r FROM d WHERE lang = 'en')
SELECT 'documents:' || CAST(pos AS VARCHAR) AS id, 'all' AS "group", source AS stratum, 1.0::DOUBLE AS weight, n_chars FROM d WHERE lang IN ('de', 'fr')
UNION ALL SELECT 'documents:' || CAST(pos AS VARCHAR), 'few', lang, round(n::DOUBLE / least(9, n), 6), n_chars FROM few WHERE r <= 9""",
    "missing_files": "SELECT 'runs/' || CAST(doc_id AS VARCHAR) AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "take_all": f"WITH {STRATA_SQL} SELECT stratum, eligible, eligible AS take FROM counts",
    "render_prompt": "SELECT p_partkey, 'Part ' || p_name || ' of ' || p_brand || ', size ' || CAST(p_size AS VARCHAR) || '.' AS \"user\" FROM part",
    "render_missing": "SELECT d.doc_id AS doc_id, lang || ': ' || COALESCE(CAST(quality AS VARCHAR), '<missing>') AS \"user\" FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "send_order": f"WITH {ORDER_SQL} SELECT id, ord FROM plan WHERE ord < 100",
    "part_slices": f"WITH {ORDER_SQL}, n AS (SELECT count(*) AS n FROM documents) SELECT id, ord FROM plan CROSS JOIN n WHERE ord >= n * 1 // 7 AND ord < n * 2 // 7",
    "row_keys": "SELECT CAST(doc_id AS VARCHAR) AS id, substr(sha256(CAST(doc_id AS VARCHAR) || '|m|p|s|a'), 1, 32) AS key, substr(sha256(CAST(doc_id AS VARCHAR) || '|m|p|guided=off|'), 1, 32) AS shared_key FROM documents",
    "resume_anti": "SELECT CAST(doc_id AS VARCHAR) AS key FROM documents WHERE doc_id % 3 <> 0",
    "resume_semi": "SELECT CAST(doc_id AS VARCHAR) AS key FROM documents WHERE doc_id % 3 = 0",
    "planned_missing": "SELECT count(*) AS planned, CAST(sum(CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM documents",
    "planned_total": "SELECT CAST(sum(least(n, 40)) AS BIGINT) AS planned FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)",
    "retry_errors": f"WITH {ATTEMPTS_SQL} SELECT key FROM last WHERE error_class IS NULL",
    "compare_plan": f"WITH {COMPARED_SQL} SELECT id, endpoint, verdict FROM compared",
    "agreement": f"WITH {COMPARED_SQL} SELECT x.endpoint AS a, y.endpoint AS b, count(*) AS \"rows\", CAST(sum(CASE WHEN x.verdict = y.verdict THEN 1 ELSE 0 END) AS BIGINT) AS agree FROM compared x JOIN compared y ON x.id = y.id AND x.endpoint < y.endpoint WHERE x.verdict IS NOT NULL AND y.verdict IS NOT NULL GROUP BY x.endpoint, y.endpoint",
    "agreement_table": f"WITH {COMPARED_SQL} SELECT x.endpoint AS a, y.endpoint AS b, x.verdict || '|' || y.verdict AS verdicts, count(*) AS \"rows\" FROM compared x JOIN compared y ON x.id = y.id AND x.endpoint < y.endpoint WHERE x.verdict IS NOT NULL AND y.verdict IS NOT NULL GROUP BY x.endpoint, y.endpoint, x.verdict || '|' || y.verdict",
    "latest_record": f"WITH {ATTEMPTS_SQL} SELECT key, seq, verdict FROM last",
    "totals": """SELECT count(*) AS "rows", CAST(sum(CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS parse_errors, CAST(sum(CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS errors,
  CAST(sum(CASE WHEN doc_id % 5 <> 0 AND doc_id % 19 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS key_order_violations, CAST(sum(CASE WHEN doc_id % 23 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS replies_with_reasoning,
  CAST(sum(CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS truncated FROM documents""",
    "group_totals": f'WITH {RESULTS_SQL} SELECT grp AS "group", count(*) AS "rows", CAST(sum(CASE WHEN judged THEN 1 ELSE 0 END) AS BIGINT) AS judged, CAST(sum(CASE WHEN judged THEN 0 ELSE 1 END) AS BIGINT) AS not_judged FROM results GROUP BY grp',
    "verdict_rates": f"WITH {RESULTS_SQL}{RATES_SQL}",
    "weighted_rates": f"""{PROPORTIONAL_SQL}, drawn AS (SELECT pos, stratum, row_number() OVER (PARTITION BY stratum ORDER BY sha256('42|all|' || stratum || '|' || CAST(pos AS VARCHAR)), pos) AS r FROM strata),
results AS (SELECT split_part(d.stratum, '/', 1) AS grp, round(eligible::DOUBLE / take, 6) AS w, {VERDICT_SQL.format(n="pos")} AS verdict, pos % 7 <> 0 AS judged FROM drawn d JOIN taken t ON d.stratum = t.stratum WHERE r <= take){RATES_SQL}""",
    "verdict_counts": f'WITH {RESULTS_SQL} SELECT grp AS "group", verdict, count(*) AS "rows" FROM results WHERE verdict IS NOT NULL GROUP BY grp, verdict',
    "stratum_crosstab": f"""WITH {RESULTS_SQL}, r AS (SELECT grp, stratum, COALESCE(verdict, 'not_judged') AS verdict FROM results)
SELECT CAST(NULL AS VARCHAR) AS "group", CAST(NULL AS VARCHAR) AS stratum, verdict, count(*) AS "rows" FROM r GROUP BY verdict
UNION ALL SELECT grp, CAST(NULL AS VARCHAR), verdict, count(*) FROM r GROUP BY grp, verdict
UNION ALL SELECT grp, stratum, verdict, count(*) FROM r GROUP BY grp, stratum, verdict""",
    "endpoint_stats": f"""WITH {RESULTS_SQL}, agg AS (SELECT endpoint, count(*) AS n, max(latency_s) AS lm, max(completion_tokens) AS cm, CAST(sum(CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS truncated,
  list_sort(list(latency_s)) AS l, list_sort(list(prompt_tokens)) AS p FROM results GROUP BY endpoint), tokens AS (SELECT endpoint, list_sort(list(completion_tokens)) AS c FROM results WHERE completion_tokens IS NOT NULL GROUP BY endpoint),
models AS (SELECT endpoint, string_agg(model, ',' ORDER BY model) AS models FROM (SELECT DISTINCT endpoint, model FROM results) GROUP BY endpoint)
SELECT a.endpoint AS endpoint, n AS "rows", models, lm AS latency_s_max, cm AS completion_tokens_max, truncated, l[CAST(round_even(0.5 * (len(l) - 1), 0) AS BIGINT) + 1] AS latency_s_p50, l[CAST(round_even(0.9 * (len(l) - 1), 0) AS BIGINT) + 1] AS latency_s_p90,
  c[CAST(round_even(0.5 * (len(c) - 1), 0) AS BIGINT) + 1] AS completion_tokens_p50, p[CAST(round_even(0.5 * (len(p) - 1), 0) AS BIGINT) + 1] AS prompt_tokens_p50
FROM agg a JOIN tokens t ON a.endpoint = t.endpoint JOIN models m ON a.endpoint = m.endpoint""",
    "quantiles_list": f"WITH {RESULTS_SQL}, agg AS (SELECT endpoint, list_sort(list(latency_s)) AS l FROM results GROUP BY endpoint) SELECT endpoint, l[CAST(round_even(0.5 * (len(l) - 1), 0) AS BIGINT) + 1] AS latency_s_p50, l[CAST(round_even(0.9 * (len(l) - 1), 0) AS BIGINT) + 1] AS latency_s_p90 FROM agg",
    "quantiles_one": "WITH v AS (SELECT list_sort(list(n_chars * 1.7::DOUBLE + doc_id / 1000::DOUBLE)) AS l FROM documents) SELECT 'one' AS endpoint, "
    + ", ".join(f"l[CAST(round_even({p}::DOUBLE / 100 * (len(l) - 1), 0) AS BIGINT) + 1] AS chars_p{p}" for p in (0, 1, 50, 90, 99, 100))
    + " FROM v",
    "summary_cube": f"""WITH {RESULTS_SQL}, r AS (SELECT grp AS "group", stratum, verdict, CASE WHEN doc_id % 11 = 0 THEN 'length' WHEN doc_id % 13 = 0 THEN 'timeout' END AS class,
  CASE WHEN doc_id % 29 = 0 THEN '{parse.UNCLOSED}' END AS note, endpoint, model, w, judged, latency_s, completion_tokens, doc_id FROM results)
SELECT CASE grouping("group", stratum, verdict, class, note, endpoint, model) WHEN 127 THEN 'total' WHEN 119 THEN 'class' WHEN 123 THEN 'note' WHEN 63 THEN 'group' WHEN 47 THEN 'verdict' WHEN 15 THEN 'stratum' WHEN 125 THEN 'endpoint' WHEN 117 THEN 'endpoint_class' ELSE 'model' END AS level,
  "group", stratum, verdict, class, note, endpoint, model, count(*) AS "rows", count(*) FILTER (doc_id % 17 = 0) AS parse_errors, count(class) AS errors, count(*) FILTER (doc_id % 5 <> 0 AND doc_id % 19 = 0) AS key_order_violations,
  count(*) FILTER (doc_id % 23 = 0) AS replies_with_reasoning, count(*) FILTER (class = 'length') AS truncated, count(*) FILTER (judged) AS judged, round(coalesce(sum(w) FILTER (judged), 0), 6) AS weight, max(latency_s) AS latency_s_max, max(completion_tokens) AS completion_tokens_max
FROM r GROUP BY GROUPING SETS ((), (class), (note), ("group"), ("group", verdict), ("group", stratum, verdict), (endpoint), (endpoint, class), (endpoint, model))""",
    "label_domain": f"WITH {RESULTS_SQL} SELECT string_agg(verdict, ',' ORDER BY verdict) AS \"values\" FROM (SELECT DISTINCT verdict FROM results WHERE verdict IS NOT NULL)",
    "superseded": """WITH a AS (SELECT user_id, event_id, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
runs AS (SELECT user_id, bad, n % 2 AS run, (n - 1) // 2 AS place FROM a), r AS (SELECT user_id, bad, row_number() OVER (PARTITION BY user_id ORDER BY run DESC, place DESC) AS r FROM runs)
SELECT CAST(user_id AS VARCHAR) AS key, bad AS is_error FROM r WHERE r = 1""",
    "endpoint_errors": f"WITH {RESULTS_SQL} SELECT endpoint, CASE WHEN doc_id % 11 = 0 THEN 'length' ELSE 'timeout' END AS class, count(*) AS \"rows\" FROM results WHERE doc_id % 11 = 0 OR doc_id % 13 = 0 GROUP BY ALL",
    "run_budget": "SELECT CAST(sum(least(n, 40) + 2) AS BIGINT) AS requests, round(sum(least(n, 40) + 2) * 0.2, 6) AS cost FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)",
    "streaming_summary": """WITH e AS (SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts) AS minute FROM events), w AS (SELECT event_type, minute - INTERVAL 1 MINUTE * k AS start FROM e CROSS JOIN range(5) t(k))
SELECT start, start + INTERVAL 5 MINUTE AS "end", event_type, count(*) AS "rows" FROM w GROUP BY start, event_type""",
    "parse_notes": f"SELECT '{parse.UNCLOSED}' AS note, count(*) AS \"rows\" FROM documents WHERE doc_id % 29 = 0",
    "error_classes": "SELECT class, count(*) AS \"rows\" FROM (SELECT CASE event_id % 8 WHEN 1 THEN 'auth' WHEN 2 THEN 'overload' WHEN 3 THEN 'timeout' WHEN 4 THEN 'down' WHEN 5 THEN 'bad_request' WHEN 6 THEN 'down' ELSE 'retry' END AS class FROM events) GROUP BY class",
    "failure_streaks": """WITH e AS (SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
runs AS (SELECT user_id, island, sum(bad) AS n FROM e GROUP BY user_id, island) SELECT user_id, CAST(max(n) AS BIGINT) AS longest FROM runs GROUP BY user_id""",
    "first_n_failed": """WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events)
SELECT user_id, count(*) = 3 AND sum(CASE WHEN event_type IN ('error', 'view') THEN 1 ELSE 0 END) = count(*) AS refuse FROM e WHERE r <= 3 GROUP BY user_id""",
    "trailing_rate": """WITH e AS (SELECT event_id, event_type, epoch_us(ts) AS m FROM events), c AS (SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY m RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW) AS last_60s,
  count(*) OVER (PARTITION BY event_type ORDER BY m RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW) AS last_300s FROM e)
SELECT event_id, last_60s, last_300s, round(100 / (last_300s::DOUBLE / 5), 3) AS eta_minutes FROM c""",
    "recent_events": """WITH e AS (SELECT event_type, event_id, user_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS r FROM events)
SELECT event_type, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY event_id) AS events FROM e WHERE r <= 30 GROUP BY event_type""",
    "sse_assembly": """WITH t AS (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS content FROM conversations GROUP BY conv_id),
f AS (SELECT conv_id, 'stop' || CAST(max(turn) AS VARCHAR) AS finish_reason FROM conversations WHERE role = 'assistant' GROUP BY conv_id) SELECT t.conv_id AS conv_id, content, finish_reason FROM t LEFT JOIN f ON t.conv_id = f.conv_id""",
    "strict_parse": """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'consistent' END AS verdict, CASE WHEN doc_id % 5 = 0 THEN 'r' || CAST(doc_id AS VARCHAR) END AS short_reason, CASE WHEN doc_id % 5 = 0 THEN TRUE END AS key_order_ok, doc_id % 5 <> 0 AS failed FROM documents""",
    "tolerant_parse": """SELECT doc_id, CASE WHEN doc_id % 5 IN (0, 3) THEN 'consistent' END AS verdict, CASE WHEN doc_id % 5 <> 4 THEN 'I say' END AS reasoning, doc_id % 5 NOT IN (0, 3) AS failed FROM documents""",
    "thought_strip": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'ac' || CAST(doc_id AS VARCHAR) ELSE 'a' END AS content FROM documents",
    "join_back": f"SELECT CAST(doc_id AS VARCHAR) AS id, lang, {VERDICT_SQL.format(n='doc_id')} AS verdict, CASE WHEN doc_id % 7 <> 0 THEN 'short' END AS short_reason FROM documents",
    "parts_union": f"WITH {ATTEMPTS_SQL} SELECT key, verdict FROM last",
    "chat_dedupe": "SELECT DISTINCT sha256(text) AS sha FROM documents",
    "rule_judging": f"""WITH {PARTS_SQL} SELECT key, id, endpoint, model, CASE WHEN NOT refused THEN v END AS verdict, CASE WHEN NOT refused THEN 'by rule: ' || v END AS short_reason,
  CASE WHEN refused THEN 'bad_request' END AS error_class, CASE WHEN NOT refused THEN length(t) // 4 END AS prompt_tokens, CASE WHEN NOT refused THEN TRUE END AS key_order_ok FROM records""",
    "judged_rates": f"""WITH {PARTS_SQL}, results AS (SELECT p_type AS grp, 1.0::DOUBLE + p_size % 3 AS w, CASE WHEN NOT refused THEN v END AS verdict, NOT refused AS judged FROM ruled){RATES_SQL}""",
    "judge_resume": f"WITH {PARTS_SQL} SELECT id, CAST(CASE WHEN refused AND ord < 100 THEN 2 ELSE 1 END AS BIGINT) AS records, v AS verdict, FALSE AS failed FROM ruled",
    "log_records": "SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS key FROM documents WHERE doc_id % 8 IN (5, 7)",
    "log_counts": "SELECT count(*) FILTER (doc_id % 8 IN (5, 7)) AS lines, count(*) FILTER (doc_id % 8 IN (1, 2, 3, 4, 6)) AS unreadable_lines FROM documents",
    "csv_places": f"WITH {PLACES_SQL} SELECT CAST(pos AS VARCHAR) AS id, CAST(doc_id AS VARCHAR) AS doc_id, part FROM places",
    "log_folder": """WITH r AS (SELECT doc_id, unnest([CASE WHEN doc_id % 10 = 0 THEN 1 END, CASE WHEN doc_id % 3 = 0 THEN 2 END, CASE WHEN doc_id % 5 <> 0 THEN 3 END]) AS run FROM documents),
s AS (SELECT doc_id, run, row_number() OVER (ORDER BY run, doc_id) - 1 AS seq FROM r WHERE run IS NOT NULL)
SELECT CAST(doc_id AS VARCHAR) AS key, max(seq) AS seq, CAST(max(run) AS VARCHAR) AS run FROM s GROUP BY doc_id""",
    "zip_places": f"WITH {PLACES_SQL} SELECT pos, CAST(doc_id AS VARCHAR) AS row_doc, CAST(doc_id AS VARCHAR) AS attr_doc FROM places",
    "zip_refusals": f"WITH {PLACES_SQL}, n AS (SELECT count(*) AS n FROM documents WHERE doc_id % 50 <> 1) SELECT pos, 'no counterpart' AS problem FROM places CROSS JOIN n WHERE pos >= n",
    "durations": """WITH s AS (SELECT event_id, event_id * 7 AS s FROM events)
SELECT event_id, CASE WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' ELSE CAST(s // 60 AS VARCHAR) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' END AS took FROM s""",
}
