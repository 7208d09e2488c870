"""Registered queries over files, streams and whole runs, and the same in SQL.

Each lays files of the given tables out, lets the library read, mirror, restore, judge or append them, and returns what
came of it. Files have ``ROWS`` rows, so there are more of them the larger the table is, and no task has more than one to write.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalogue import ENDPOINTS, ORDER_SQL, PARTS_SQL, PROMPT, RESULTS_SQL, RULES, VALUES, Query, parts, results, table
from .functions import parse
from .operators import sampling, summary
from .plans import plan as plans
from .plans.judge import Options, judge, judge_folder, preview, taken_over
from .sources import items as sources
from .sources.sinks import absolute, append_new, read_json, read_table_of, scratch, write_items, write_json, write_order
from .streaming import mirror as mirrors
from .streaming import states

#: Rows of a file.
ROWS = 150
#: Requests of a run for each pool.
LIMIT = 100
#: The watermark's delay, in minutes.
LATE = 10


def block(number: Column) -> Column:
    return F.lpad(F.floor(number / ROWS).cast("string"), 9, "0")


BLOCK_SQL = f"lpad(CAST({{n}} // {ROWS} AS VARCHAR), 9, '0')"


def named_files(rows: DataFrame, kind: str, order: str, folder: str, name: str) -> None:
    """One file for each ``block``, its rows by ``order``, as ``folder/name`` (a format string of the block).

    A file of that name is replaced, as a log by what it has grown to. Tasks write the files under their names, so the driver touches none.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != "block"]
    head = "" if kind == "text" else ",".join(columns) + "\n"
    line = F.coalesce("value", F.lit("")) if kind == "text" else F.to_csv(F.struct(*columns), {"escape": '"'})
    # A number of its own: the rows may be few bytes, the files are many all the same.
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = rows.repartition(tasks, "block").sortWithinPartitions("block", order).select("block", line.alias("line"))
    target = absolute(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(target)
        files.create_dir(root, recursive=True)
        at = out = part = None

        def end() -> None:
            if out is not None:
                out.close()
                mirrors.replaced(files, part, f"{root.rstrip('/')}/{name.format(at)}")

        for batch in batches:
            for block, text in zip(*(c.to_pylist() for c in batch.columns)):
                if block != at or out is None:
                    end()
                    at, part = block, f"{root.rstrip('/')}/.{uuid.uuid4().hex}"
                    out = files.open_output_stream(part)
                    out.write(head.encode())
                out.write(f"{text}\n".encode())
        end()
        yield from ()

    laid.mapInArrow(write, "block string").write.format("noop").mode("overwrite").save()


def items_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as items, written as JSON lines in order of their identifiers and read back with their lines."""
    path = scratch(spark, "items")
    items = parts(spark, sf_dir).withColumn("fields", F.from_json("fields_json", "p_name string, p_brand string, p_size long"))
    write_items(items.select("id", "fields", "group", F.col("fields.p_brand").alias("stratum"), "weight"), path, {"rows": "part"})
    back = sources.jsonl_items(spark, path, numbered=True)
    return back.select("line", "id", F.get_json_object("fields_json", "$.p_name").alias("p_name"), "group", "stratum", "weight")


def send_order_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The send order of all documents as CSV, read back: each row's place in the files is its place in the order."""
    path = scratch(spark, "order")
    docs = table(spark, sf_dir, "documents")
    items = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("group"), F.col("source").alias("stratum"), F.lit(1.0).alias("weight"))
    write_order(plans.send_order(items), path)
    back = sources.positioned(sources.read_table(spark, path, breaks=False))
    return back.select("pos", F.col("order").cast("long").alias("ord"), "id", "group", "stratum")


def grown_logs(spark: SparkSession, sf_dir: str, value: Column) -> tuple[str, str]:
    """Logs of documents' lines that are mirrored twice: half written, and whole. (source, target)."""
    root = scratch(spark, "mirrored")
    source, target = f"{root}/source", f"{root}/target"
    rows = table(spark, sf_dir, "documents").select("doc_id", block(F.col("doc_id")).alias("block"), value.alias("value"))
    for part in (rows.where(F.col("doc_id") % ROWS < ROWS // 2), rows):
        named_files(part, "text", "doc_id", source, "run-{}.jsonl")
        mirrors.mirror(spark, source, target, f"{root}/state").awaitTermination()
    return source, target


def mirrored_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that a mirror of growing logs has, each with its place in all of them, read one after another."""
    record = F.concat(F.lit('{"key": "'), F.col("doc_id"), F.lit('", "sha": "'), F.sha2(F.coalesce("text", F.lit("")), 256), F.lit('"}'))
    _, target = grown_logs(spark, sf_dir, record)
    records, _ = sources.read_results(spark, f"{target}/*.jsonl")
    return records.select("seq", "key", F.get_json_object("value", "$.sha").alias("sha"))


def mirror_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every log on either side of a mirror that lacks the last lines, since the logs grew after it."""
    source, target = grown_logs(spark, sf_dir, F.col("doc_id").cast("string"))
    more = table(spark, sf_dir, "documents").select("doc_id", block(F.col("doc_id")).alias("block"), F.explode(F.array(F.lit("a"), F.when(F.col("doc_id") % (2 * ROWS) < ROWS, "b"))).alias("value"))
    named_files(more.where("value is not null"), "text", "doc_id", source, "run-{}.jsonl")
    return mirrors.verified(spark, source, target)


def restored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, lines and hash of every log, of whole texts, that a machine which has none of them gets back from a mirror."""
    text = F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.translate(F.coalesce("text", F.lit("")), "\n\r", "  "))
    _, target = grown_logs(spark, sf_dir, text)
    back = scratch(spark, "restored")
    got = mirrors.restored(spark, target, back)
    where = scratch(spark, "copied")
    got.write.parquet(where)
    hashed = sources.hashed_files(spark, back)
    return spark.read.schema(got.schema).parquet(where).join(hashed, F.col("file") == F.col("file_name")).select("file", "bytes", "lines", "sha256")


def appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends that share keys, the first with every key twice: each key's one record, and which append it is of."""
    path = scratch(spark, "appended")
    n = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(n.alias("seq"), n.cast("string").alias("key"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    first = rows.where("seq % 3 <> 0").withColumn("part", F.lit("first"))
    append_new(first.unionAll(first), path)
    append_new(rows.where("seq % 2 = 0").withColumn("part", F.lit("second")), path)
    return read_table_of(spark, path).select("key", "sha", "part")


def folder_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over a folder of pools of all parts, with a limit and a send order for each of them."""
    root = scratch(spark, "pools")
    pools = table(spark, sf_dir, "part").select(block(F.col("p_partkey")).alias("block"), F.col("p_partkey").cast("string").alias("id"), "p_name", "p_brand", F.col("p_size").cast("string").alias("p_size"), F.col("p_type").alias("group"))
    named_files(pools, "csv", "id", f"{root}/in", "parts-{}.csv")
    done = judge_folder(spark, f"{root}/in", f"{root}/out", PROMPT, ENDPOINTS[:1], RULES, Options(limit=LIMIT), breaks=False)
    return done.select("file_name", "id", "seq", "key", "group", "verdict", F.col("error.class").alias("error_class"))


def streamed_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures in a row and refusals of every user, by state on a stream of all events; the last minutes wait for the watermark."""
    root = scratch(spark, "failures")
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    rows.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        found = states.failures(stream, "user_id", "ts", "event_id", F.col("event_type").isin("error", "view"), first=3, late=f"{LATE} minutes")
        run = found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, before)
    run.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{root}/out").select("user_id", F.col("tie").alias("event_id"), "streak", "place", "refuse")


def zipped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their labels in two folders of files, zipped by place, with the sum of both sides' characters."""
    root = scratch(spark, "zipped")
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    both = docs.join(labels, "doc_id", "left").withColumn("block", block(F.col("doc_id")))
    sides = {"rows": both.select("block", "doc_id", "lang", F.length(F.coalesce("text", F.lit(""))).alias("chars")), "attributes": both.select("block", "doc_id", "quality")}
    for side, rows in sides.items():
        named_files(rows, "csv", "doc_id", f"{root}/{side}", "{}.csv")
    pairs = sampling.zipped(*[sources.read_table(spark, f"{root}/{side}", breaks=False) for side in sides], by_file=True)
    return pairs.select("pos", F.col("row.doc_id").alias("doc_id"), "row.lang", F.col("row.chars").cast("long").alias("chars"), F.col("attr.doc_id").alias("attr_doc"), F.col("attr.quality").cast("int").alias("quality"))


def run_taken_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of 100 parts that is mirrored, taken over elsewhere, and ended there: all records, those of there behind those of here."""
    root, items = scratch(spark, "taken"), parts(spark, sf_dir)
    judge(items, f"{root}/here", PROMPT, ENDPOINTS[:1], RULES, Options(limit=LIMIT, session="here", buckets=4))
    mirrors.mirror(spark, f"{root}/here", f"{root}/mirror", f"{root}/state").awaitTermination()
    there = taken_over(spark, f"{root}/mirror", f"{root}/there")
    return judge(items, there, PROMPT, ENDPOINTS[:1], RULES, Options(session="there")).select("id", "seq", "session", "verdict")


def run_companions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run over all parts, in two sessions, writes beside its records: send order, manifest and summary."""
    out, items = scratch(spark, "companions"), parts(spark, sf_dir)
    for limit in (LIMIT, 0):
        judge(items, out, PROMPT, ENDPOINTS[:1], RULES, Options(limit=limit, session=f"first {limit}", buckets=4))
    manifest, last = read_json(spark, f"{out}/_run/manifest.json"), read_json(spark, f"{out}/_run/summary.json")
    noted = {"pool_rows": manifest["items_rows"], "sessions": len(manifest["sessions"]), "prompt_sha": manifest["prompt_sha"], "planned": last["planned"], "missing": last["missing"], "errors": last["errors"]}
    order = sources.read_table(spark, f"{out}/_run/order", breaks=False)
    return order.select("id", F.col("order").cast("long").alias("ord"), *[F.lit(v).cast("string" if isinstance(v, str) else "long").alias(n) for n, v in noted.items()])


def run_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sessions with a ceiling of 60 requests each over all parts and two endpoints: what was sent."""
    out, items = scratch(spark, "ceiling"), parts(spark, sf_dir)
    for _ in range(2):
        done = judge(items, out, PROMPT, ENDPOINTS, RULES, Options(mode="compare", max_requests=60, probe=0))
    return done.select("key", "id", "endpoint")


def summary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of a summary of all documents' records, by their path in the document as it is stored.

    The document rounds the exact binary value, ties to even, as ``format`` does in its SQL; tables of rates round halves up.
    """
    place = f"{scratch(spark, 'summary')}/summary.json"
    rows = results(spark, sf_dir)
    write_json(spark, place, summary.document(rows, VALUES, planned=rows.count() + 5))

    def leaves(value, path: str = ""):
        for name, inner in value.items():
            if isinstance(inner, dict):
                yield from leaves(inner, f"{path}{name}/")
            elif isinstance(inner, (int, float)) and not isinstance(inner, bool):
                yield f"{path}{name}", float(inner)

    stored = read_json(spark, place)
    return spark.createDataFrame([r for r in leaves(stored) if not r[0].startswith("by_endpoint/")], "path string, value double")


QUERIES: dict[str, Query] = {
    "items_jsonl": items_jsonl,
    "send_order_csv": send_order_csv,
    "mirrored_logs": mirrored_logs,
    "mirror_check": mirror_check,
    "restored_files": restored_files,
    "appended_once": appended_once,
    "folder_run": folder_run,
    "streamed_failures": streamed_failures,
    "zipped_texts": zipped_texts,
    "dry_run": lambda s, d: preview(parts(s, d), PROMPT, ENDPOINTS[:1]).select("id", "key", "user"),
    "run_taken_over": run_taken_over,
    "run_companions": run_companions,
    "run_ceiling": run_ceiling,
    "summary_document": summary_document,
}

ORACLES: dict[str, str] = {
    "items_jsonl": """SELECT row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS line, CAST(p_partkey AS VARCHAR) AS id, p_name, p_type AS "group", p_brand AS stratum, (1 + p_size % 3)::DOUBLE AS weight FROM part""",
    "send_order_csv": f'WITH {ORDER_SQL} SELECT ord AS pos, ord, p.id AS id, lang AS "group", source AS stratum FROM plan p JOIN documents d ON p.doc_id = d.doc_id',
    "mirrored_logs": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seq, CAST(doc_id AS VARCHAR) AS key, sha256(COALESCE(text, '')) AS sha FROM documents",
    "mirror_check": f"""WITH n AS (SELECT doc_id // {ROWS} AS b, count(*) AS n FROM documents GROUP BY b)
SELECT 'run-' || {BLOCK_SQL.format(n=f'(b * {ROWS})')} || '.jsonl' AS file, CASE WHEN b % 2 = 0 THEN 2 * n ELSE n END AS source_lines, n AS target_lines, b % 2 = 1 AS same FROM n""",
    "restored_files": f"""WITH l AS (SELECT doc_id, CAST(doc_id AS VARCHAR) || ' ' || replace(replace(COALESCE(text, ''), chr(10), ' '), chr(13), ' ') || chr(10) AS line FROM documents)
SELECT 'run-' || {BLOCK_SQL.format(n="doc_id")} || '.jsonl' AS file, CAST(sum(strlen(line)) AS BIGINT) AS bytes, count(*) AS lines, sha256(string_agg(line, '' ORDER BY doc_id)) AS sha256 FROM l GROUP BY file""",
    "appended_once": "SELECT CAST(doc_id AS VARCHAR) AS key, sha256(COALESCE(text, '')) AS sha, CASE WHEN doc_id % 3 <> 0 THEN 'first' ELSE 'second' END AS part FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0",
    "folder_run": f"""WITH {PARTS_SQL}, f AS (SELECT *, 'parts-' || {BLOCK_SQL.format(n="p_partkey")} || '.csv' AS file_name FROM ruled),
o AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY sha256('42|order|' || id), id) - 1 AS seq FROM f)
SELECT file_name, id, seq, substr(sha256(id || '|m1|{PROMPT.sha}|{PROMPT.contract.schema_sha()}|'), 1, 32) AS key, p_type AS "group", CASE WHEN NOT refused THEN v END AS verdict, CASE WHEN refused THEN 'bad_request' END AS error_class FROM o WHERE seq < {LIMIT}""",
    "streamed_failures": f"""WITH w AS (SELECT epoch_ms(max(ts)) - {LATE} * 60000 AS w FROM events), e AS (SELECT user_id, event_id, ts, event_type IN ('error', 'view') AS bad FROM events),
p AS (SELECT *, row_number() OVER o AS place, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER o AS island FROM e WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS streak, sum(CASE WHEN bad AND place <= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS early FROM p)
SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, CAST(streak AS BIGINT) AS streak, place, place >= 3 AND early >= 3 AS refuse FROM s CROSS JOIN w WHERE epoch_ms(ts) < w""",
    "zipped_texts": """SELECT row_number() OVER (ORDER BY d.doc_id) - 1 AS pos, CAST(d.doc_id AS VARCHAR) AS doc_id, lang, CAST(length(COALESCE(text, '')) AS BIGINT) AS chars, CAST(d.doc_id AS VARCHAR) AS attr_doc, CAST(l.quality AS INTEGER) AS quality
FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id""",
    "dry_run": f"""WITH {PARTS_SQL} SELECT id, substr(sha256(id || '|m1|{PROMPT.sha}|{PROMPT.contract.schema_sha()}|'), 1, 32) AS key, t AS "user" FROM ruled WHERE ord = 0""",
    "run_taken_over": f"""WITH {PARTS_SQL} SELECT id, CASE WHEN ord < {LIMIT} THEN ord ELSE ord + {LIMIT} END AS seq, CASE WHEN ord < {LIMIT} THEN 'here' ELSE 'there' END AS session, CASE WHEN NOT refused THEN v END AS verdict FROM ruled""",
    "run_companions": f"""WITH {PARTS_SQL} SELECT id, ord, count(*) OVER () AS pool_rows, CAST(2 AS BIGINT) AS sessions, '{PROMPT.sha}' AS prompt_sha, count(*) OVER () AS planned, CAST(0 AS BIGINT) AS missing,
  count(*) FILTER (refused) OVER () AS errors FROM ruled""",
    "run_ceiling": f"""WITH {PARTS_SQL}, t AS (SELECT *, row_number() OVER (ORDER BY sha256(key), key) AS turn FROM records) SELECT key, id, endpoint FROM t WHERE turn <= 120""",
    "summary_document": f"""WITH {RESULTS_SQL}, c AS (SELECT *, CASE WHEN doc_id % 11 = 0 THEN 'length' WHEN doc_id % 13 = 0 THEN 'timeout' END AS class, row_number() OVER () AS r FROM results),
g AS (SELECT grp, count(*) AS n, count(*) FILTER (judged) AS j, sum(w) FILTER (judged) AS w FROM c GROUP BY grp),
h AS (SELECT g.grp, v.verdict, any_value(j) AS j, any_value(g.w) AS w, count(c.doc_id) AS n, sum(c.w) AS hit FROM g CROSS JOIN (VALUES ('consistent'), ('inconsistent'), ('unsure')) AS v(verdict) LEFT JOIN c ON c.grp = g.grp AND c.verdict = v.verdict GROUP BY g.grp, v.verdict),
p AS (SELECT 'rows' AS path, count(*) AS value FROM c UNION ALL SELECT 'planned', count(*) + 5 FROM c UNION ALL SELECT 'missing', 5 UNION ALL SELECT 'parse_errors', count(*) FILTER (doc_id % 17 = 0) FROM c
  UNION ALL SELECT 'errors', count(class) FROM c UNION ALL SELECT 'key_order_violations', count(*) FILTER (doc_id % 5 <> 0 AND doc_id % 19 = 0) FROM c
  UNION ALL SELECT 'replies_with_reasoning', count(*) FILTER (doc_id % 23 = 0) FROM c UNION ALL SELECT 'truncated', count(*) FILTER (class = 'length') FROM c
  UNION ALL SELECT 'errors_by_class/' || class, count(*) FROM c WHERE class IS NOT NULL GROUP BY class UNION ALL SELECT 'errors_by_endpoint/' || endpoint || '/' || class, count(*) FROM c WHERE class IS NOT NULL GROUP BY endpoint, class
  UNION ALL SELECT 'parse_notes/{parse.UNCLOSED}', count(*) FROM c WHERE doc_id % 29 = 0 HAVING count(*) > 0
  UNION ALL SELECT 'by_group/' || grp || '/rows', n FROM g UNION ALL SELECT 'by_group/' || grp || '/judged', j FROM g UNION ALL SELECT 'by_group/' || grp || '/not_judged', n - j FROM g
  UNION ALL SELECT 'by_group/' || grp || '/by_stratum/' || stratum || '/' || COALESCE(verdict, 'not_judged'), count(*) FROM c GROUP BY grp, stratum, verdict)
SELECT path, value::DOUBLE AS value FROM p UNION ALL SELECT 'by_group/' || grp || '/rates/' || verdict, CAST(format('{{:.4f}}', n::DOUBLE / greatest(1, j)) AS DOUBLE) FROM h
UNION ALL SELECT 'by_group/' || grp || '/rates_weighted/' || verdict, CAST(format('{{:.4f}}', COALESCE(hit, 0) / COALESCE(NULLIF(w, 0), 1.0::DOUBLE)) AS DOUBLE) FROM h""",
}
