"""The training-data pipeline over ``documents``: five stages, each a table that the next one reads.

1. toxicity: documents that the classifier rejects go;
2. near_duplicates: of each group of linked texts the one with the smallest identifier stays;
3. secrets: secret spans are replaced by a mark, and n_chars follows;
4. mixing: documents are laid out in the order of the target weights;
5. tokens: texts become byte-level BPE ids, with their decoding checked; ``mix_position`` has each
   row's place in the table that stage 4 laid out, so that order survives any later scan.

SQL can't express the stages, so ``ORACLE_SQL`` is None and tests hold them against brute force.
Edge cases: each stage takes nulls, repeated rows, extra columns and empty tables as its operator
says; a document that no stage rejects is in the result once for each of its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugemill.llm import bpe, mixing, near, queries, secrets, toxicity
from gaugemill.llm.common import written

ORACLE_SQL = None
#: A document goes if its score is at least this.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents; labels are learnt only from rows that aren't held out."""
    labels = queries.table(spark, sf_dir, "labels").where(~queries.held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels), to="__score")
    return scored.where(F.col("__score") < TOXIC).drop("__score").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.dedupe(docs).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, words=queries.vocabulary(queries.SECRETS_WORDS)).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def lay_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in order of their places in the mix, in files that follow one another."""
    places = mixing.mix(docs)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return places.repartitionByRange(parts, "mix_position").sortWithinPartitions("mix_position").select(*docs.columns)


def placed(docs: DataFrame) -> DataFrame:
    """Adds mix_position (long, from 0): the row's place in the files that the table is written in.

    Files follow one another by the number of the task that wrote them, rows by their index in the
    file, however the scan packs or splits files. A table that isn't a plain scan is written first.
    """
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        docs = written(docs, "laid")
    rows = docs.select(*docs.columns, F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    # One row a file; the driver lists as many when it plans the scan.
    number = F.regexp_extract("__file", r"part-([0-9]+)", 1).try_cast("long")
    before = Window.orderBy(number, "__file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("__file").agg(F.count("*").alias("n"))
    files = files.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    return rows.join(F.broadcast(files), "__file").select(*docs.columns, (F.col("__first") + F.col("__index")).alias("mix_position"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = queries.vocabulary("byte_bpe_multi_50k.tiktoken")
    both = bpe.coded(placed(docs).select("mix_position", "doc_id", "lang", "source", "text"), path, same="round_trip")
    return both.select("mix_position", "doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", lay_out),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
