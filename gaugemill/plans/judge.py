"""A judging run: render, plan, resume, ask, parse, append, summarise.

Records go to one table; beside them, in its folder ``_run`` (which Spark's readers pass over), stand the
manifest, the prompt's texts, the send order and the last summary.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.contract import Prompt
from ..functions.parse import parsed
from ..functions.template import placeholders, render_json
from ..sources.config import ConfigError, Endpoint
from ..sources.items import folder_items, validated
from ..operators.log import first_all_failed, latest
from ..operators.summary import SUMMED, document
from ..sources.sinks import BUCKETS, absolute, append_new, check_manifest, locked, read_json, read_table_of, remove, scratch, write_json, write_order, write_text
from ..streaming.mirror import restored
from . import plan as plans
from .backends import Backend, RuleBackend, ask, preflight, request_body

#: Records of one pool of a folder that a task writes as one file.
FILE_ROWS = 1_000_000


@dataclass
class Options:
    seed: int = 42
    mode: str = "shard"
    limit: int = 0
    part: str = ""
    guided: bool = True
    retry_errors: bool = False
    max_requests: int = 0
    run_tag: str = ""
    session: str = ""
    decoding: dict = field(default_factory=dict)
    buckets: int = BUCKETS  # of a new table of records
    preflight: bool = True  # for backends that have endpoints to look at
    probe: int = 20  # an endpoint whose first replies all fail to parse is refused; 0: never

    def __post_init__(self) -> None:
        if self.mode not in ("shard", "compare"):
            raise ConfigError("mode must be shard or compare")
        for name in ("guided", "retry_errors", "preflight"):
            if not isinstance(getattr(self, name), bool):
                raise ConfigError(f"{name} must be true or false")
        for kind, names in ((int, ("seed", "limit", "max_requests", "probe", "buckets")), (str, ("mode", "part", "run_tag", "session"))):
            for name in names:
                if isinstance(value := getattr(self, name), bool) or not isinstance(value, kind):
                    raise ConfigError(f"{name} must be {'a whole number' if kind is int else 'a text'}, not {value!r}")


def refuse_guided_prose(prompt: Prompt, options: Options) -> None:
    if prompt.contract.prose and options.guided:
        raise ConfigError("a prompt that asks for prose has no schema to guide replies by; say guided=False")


def ordered(items: DataFrame, options: Options) -> DataFrame:
    """The items of this run's limit and part, in send order."""
    order = plans.first_in_order(items, options.limit, options.seed)
    return plans.part_of(order, options.part) if options.part else order


def planned(items: DataFrame, prompt: Prompt, endpoints: list[Endpoint], options: Options) -> DataFrame:
    """The whole plan of a run: order, limit, part, endpoints, keys and rendered messages."""
    refuse_guided_prose(prompt, options)
    return planned_from(ordered(items, options), prompt, endpoints, options)


def planned_from(order: DataFrame, prompt: Prompt, endpoints: list[Endpoint], options: Options) -> DataFrame:
    table = plans.endpoint_table(order.sparkSession, endpoints)
    plan = plans.compare_plan(order, table) if options.mode == "compare" else plans.shard_plan(order, endpoints)
    plan = plans.keyed(plan, prompt.sha, prompt.contract.schema_sha() if options.guided else None, options.mode == "compare")
    return plan.withColumn("user", render_json(prompt.user, F.col("fields_json")))


def recorded(replies: DataFrame, prompt: Prompt, options: Options, after: int = -1, kept: tuple[str, ...] = ()) -> DataFrame:
    """Replies as result records, numbered behind ``after``; a reply with an error is never a verdict."""
    answer = parsed(F.when(F.col("error_class").isNull(), F.col("content")), prompt.contract, options.guided)
    rows = replies.withColumn("p", answer)
    good = F.col("error_class").isNull()
    field = lambda n: F.when(good, F.col(f"p.{n}")).alias(n)
    bad_parse = F.when(good & F.col("p.parse_error").isNotNull(), F.lit("parse"))
    return rows.select(
        (F.col("ord") + after + 1).alias("seq"), "key", F.lit(options.run_tag).alias("run_tag"), F.lit(options.session).alias("session"), "id", "group", "stratum", "weight", "endpoint", "model",
        F.lit(prompt.name).alias("prompt"), F.lit(prompt.sha).alias("prompt_sha"), F.lit(prompt.contract.schema_sha()).alias("schema_sha"), F.lit(options.guided).alias("guided"), F.lit(prompt.contract.label).cast("string").alias("label"),
        field("answer_json"), field("verdict"), field("short_reason"), field("reasoning"), field("parse_note"), field("key_order_ok"), field("parse_error"),
        F.when(~good | bad_parse.isNotNull(), F.struct(F.coalesce("error_class", bad_parse).alias("class"), F.coalesce("error_detail", F.col("p.parse_error")).alias("detail"))).alias("error"),
        "attempts", F.col("content").alias("raw"), "finish_reason", "latency_s", "prompt_tokens", "completion_tokens", F.date_trunc("second", F.current_timestamp()).alias("ts"), *kept,
    )


def judge(items: DataFrame, out: str, prompt: Prompt, endpoints: list[Endpoint], backend: Backend | None = None, options: Options | None = None) -> DataFrame:
    """Judges what ``out`` has no record of yet, appends it there, and returns all records.

    The pool, the run's earlier settings and the endpoints are checked before the pool is sent. Requests
    are spread over tasks by endpoint and key; a task or a run that is repeated asks only for replies that no
    earlier attempt left in ``_run/journal``, which goes when the records are committed. New records are numbered behind all that are there, so that they supersede them.
    """
    options, spark, backend = options or Options(), items.sparkSession, backend or RuleBackend()
    refuse_guided_prose(prompt, options)
    validated(items, placeholders(prompt.user))
    # The pool in send order, once: all that follows reads this table.
    place = scratch(spark, "order")
    order = ordered(items, options)
    order.write.parquet(place)
    order = spark.read.schema(order.schema).parquet(place)
    plan = planned_from(order, prompt, endpoints, options)
    session = {"session": options.session, "part": options.part, "limit": options.limit, "items_rows": items.count(), "decoding": options.decoding or getattr(backend, "options", {}), "endpoints": [e.name for e in endpoints]}
    note = start(spark, out, order, prompt, options, session)
    if options.preflight and hasattr(backend, "models") and (first := plan.select("user").first()):
        for endpoint in endpoints:
            preflight(backend, prompt, first.user, endpoint, options.guided)
        if hasattr(backend, "waiting"):  # what else the servers had to do when the session began
            session["waiting"] = {e.name: queued(backend, e) for e in endpoints}
    with locked(spark, f"{out}/_run/lock"):  # runs that start at once write these one after another
        note()
    old = read_table_of(spark, out)
    if old is not None:
        plan = plans.remaining(plan, plans.done_keys(old, options.retry_errors))
    if options.max_requests:
        plan = plans.numbered(plan, F.sha2("key", 256), F.col("key"), "turn").where(F.col("turn") < options.max_requests).drop("turn")
    # Runs of unlike parts have journals of their own.
    journal = None if getattr(backend, "local", False) else f"{out}/_run/journal/{options.part.replace('/', '-of-') or 'all'}"

    def send(part: DataFrame, seen: int) -> None:
        replies = ask(part, prompt.system, prompt.contract, backend, endpoints, journal and absolute(spark, journal))
        append_new(recorded(replies, prompt, options, after), out, after, seen, options.buckets)
        if journal:
            remove(spark, journal)  # all of it is committed now

    after, seen = -1 if old is None else old.agg(F.max("seq")).first()[0], None
    if options.probe and old is None:
        turn = F.row_number().over(Window.partitionBy("endpoint").orderBy("ord"))
        send(plan.withColumn("__turn", turn).where(F.col("__turn") <= options.probe).drop("__turn"), after)
        head = read_table_of(spark, out)
        verdict = first_all_failed(head, ["endpoint"], ["seq"], F.col("error.class").eqNullSafe("parse"), options.probe)
        if bad := [r.endpoint for r in verdict.where("refuse").collect()]:
            raise ConfigError(f"the first {options.probe} replies of {', '.join(sorted(bad))} all failed to parse")
        plan, seen = plans.remaining(plan, head.select("key")), head.agg(F.max("seq")).first()[0]
    send(plan, after if seen is None else seen)
    done = read_table_of(spark, out)
    summed = document(latest(done, columns=SUMMED), list(prompt.contract.values), planned=plan_size(order, endpoints, options))
    with locked(spark, f"{out}/_run/lock"):
        write_json(spark, f"{out}/_run/summary.json", summed)
    remove(spark, place)
    return done


def judge_folder(spark: SparkSession, folder: str, out: str, prompt: Prompt, endpoints: list[Endpoint], backend: Backend | None = None, options: Options | None = None, breaks: bool = True) -> DataFrame:
    """One run over all CSV pools of a folder: what a run for each file would record, as one job.

    Places, orders and limits are each file's own. Records go to ``out`` by ``file_name``; files that are judged again replace
    their own records and no others. All pools are checked before anything is sent.
    """
    options, backend = options or Options(), backend or RuleBackend()
    refuse_guided_prose(prompt, options)
    # The pools once: they may be many small files, and all that follows reads this table.
    place, items = scratch(spark, "pools"), folder_items(spark, folder, breaks)
    items.write.parquet(place)
    items = spark.read.schema(items.schema).parquet(place)
    # Identifiers are unique within a file.
    validated(items.withColumn("id", F.when(F.col("id") != "", F.concat_ws("\u0000", "file_name", "id"))), placeholders(prompt.user))
    order = plans.folder_order(items, options.limit, options.seed)
    plan = planned_from(order, prompt, endpoints, options)
    # Rows of two files may have one key: in a run over both they are two requests.
    plan = plan.withColumn("__key", F.col("key")).withColumn("key", F.sha2(F.concat_ws("|", "file_name", "key"), 256))
    replies = ask(plan, prompt.system, prompt.contract, backend, endpoints).withColumn("key", F.col("__key"))
    records = recorded(replies, prompt, options, kept=("file_name",))
    # A pool's records meet before they are written, or each task would add a file to every pool.
    piece = F.floor(F.col("seq") / FILE_ROWS)
    records.repartition("file_name", piece).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_name").parquet(out)
    remove(spark, place)
    return spark.read.parquet(out)


def queued(backend: Backend, endpoint: Endpoint) -> float | None:
    """The endpoint's queue by its metrics page; None for a server that has no such page."""
    try:
        return backend.waiting(endpoint)
    except (OSError, ValueError):
        return None


def plan_size(order: DataFrame, endpoints: list[Endpoint], options: Options) -> int:
    return order.count() * (len(endpoints) if options.mode == "compare" else 1)


def start(spark: SparkSession, out: str, order: DataFrame, prompt: Prompt, options: Options, session: dict) -> Callable[[], None]:
    """Refuses a run whose settings changed; what comes back writes the manifest and its companions."""
    meta = {
        "prompt": prompt.name, "prompt_sha": prompt.sha, "schema_sha": prompt.contract.schema_sha(), "key_order": list(prompt.contract.order), "guided": options.guided,
        "mode": options.mode, "seed": options.seed, "decoding": session["decoding"], "items_rows": session["items_rows"],
    }
    manifest = check_manifest(read_json(spark, f"{out}/_run/manifest.json"), meta, session)

    def note() -> None:
        write_json(spark, f"{out}/_run/manifest.json", manifest)
        for name in ("system", "user"):
            write_text(spark, f"{out}/_run/prompt/{name}.md", getattr(prompt, name))
        write_order(order, f"{out}/_run/order")

    return note


def run_id(now: datetime | None = None, tag: str = "") -> str:
    """A run's name by its time in UTC; a tag must be safe in a path."""
    if tag and not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", tag):
        raise ConfigError(f"{tag!r} can't be part of a path")
    stamp = (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    return f"{stamp}-{tag}" if tag else stamp


def request_example(items: DataFrame, prompt: Prompt, endpoints: list[Endpoint], options: Options | None = None) -> dict | None:
    """The first request as it would be sent, for a dry run; None for an empty plan."""
    options = options or Options()
    first = preview(items, prompt, endpoints, options).first()
    return first and request_body(endpoints[0], prompt.system, first.user, prompt.contract, options.decoding | {"guided": options.guided})


def preview(items: DataFrame, prompt: Prompt, endpoints: list[Endpoint], options: Options | None = None) -> DataFrame:
    """The first planned message, for a dry run that sends and pins nothing."""
    return planned(items, prompt, endpoints, options or Options()).orderBy("ord").limit(1)


def taken_over(spark: SparkSession, remote: str, home: str) -> str:
    """The folder below ``home`` in which the run that is mirrored at ``remote`` goes on, with what it lacks restored first.

    The name is the same on any machine, so a run that is taken over twice finds what it has; files that are there
    already are left alone. Hand the result to ``judge`` as its ``out``.
    """
    out = f"{home.rstrip('/')}/{local_copy_name(remote)}"
    restored(spark, remote, out).write.format("noop").mode("overwrite").save()
    return out


def local_copy_name(path: str) -> str:
    """A folder name that is the same for the same path on any machine."""
    return f"{os.path.basename(path.rstrip('/'))}-{hashlib.sha256(path.encode()).hexdigest()[:8]}"
