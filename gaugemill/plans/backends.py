"""Backends: what answers a request. Rules for offline runs, and HTTP by the standard library.

A backend turns (system, user, contract, endpoint) into a reply. ``ask`` runs it over a plan in
batches of Arrow rows, never as a scalar function, so that each row is sent once in a task.
"""

from __future__ import annotations

import base64
import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace

import pandas as pd
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contract import CANARY, Contract, Prompt
from ..functions.scalars import STATUS_CLASSES
from ..sources.config import ConfigError, Endpoint, join_url

REPLY = "content string, finish_reason string, latency_s double, prompt_tokens bigint, completion_tokens bigint, error_class string, error_detail string, attempts int"


@dataclass
class Reply:
    content: str | None = None
    finish_reason: str | None = None
    prompt_tokens: int | None = None
    completion_tokens: int | None = None
    error_class: str | None = None
    error_detail: str | None = None


Backend = Callable[[str, str, Contract, Endpoint], Reply]


@dataclass
class RuleBackend:
    """Answers by the first rule whose texts all stand in the user message, and refuses messages that have ``refuse``."""

    rules: tuple[tuple[tuple[str, ...], str], ...] = ()
    otherwise: str = "consistent"
    refuse: str = ""
    local = True  # it answers where the rows are, and no endpoint is asked

    def __call__(self, system: str, user: str, contract: Contract, endpoint: Endpoint) -> Reply:
        if self.refuse and self.refuse in user:
            return Reply(error_class="bad_request", error_detail=f"the message has {self.refuse}")
        verdict = next((v for texts, v in self.rules if all(t in user for t in texts)), self.otherwise)
        answer = {k: verdict if k == contract.label else f"by rule: {verdict}" for k in contract.order}
        content = json.dumps(answer) if answer else f"The row is {verdict}."
        return Reply(content, "stop", len(user) // 4, 12)


def class_of_status(status: int) -> str:
    return next((n for n, codes in STATUS_CLASSES.items() if status in codes), "retry")


def request_body(endpoint: Endpoint, system: str, user: str, contract: Contract, options: dict) -> dict:
    """The request: fields that are None are left out, extra ones merged, dropped ones removed."""
    messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": user}]
    body = {"model": endpoint.model, "messages": messages} | options
    if contract.schema and options.get("guided", True):
        body["response_format"] = {"type": "json_schema", "json_schema": {"name": "answer", "schema": contract.schema, "strict": True}}
    body.pop("guided", None)
    body |= endpoint.extra
    return {k: v for k, v in body.items() if v is not None and k not in endpoint.drop}


def authorization(key: str, scheme: str = "bearer") -> str:
    return {"bearer": f"Bearer {key}", "basic": f"Basic {base64.b64encode(key.encode()).decode()}", "raw": key}[scheme]


def events_of(lines: Iterable[str]) -> Iterator[dict]:
    """The JSON objects of server-sent events; comments, marks and broken lines are passed over."""
    for line in lines:
        name, _, data = line.partition(":")
        try:
            event = json.loads(data) if name == "data" else None
        except ValueError:
            continue
        if isinstance(event, dict):
            yield event


def stream_text(lines: Iterable[str]) -> Reply:
    """A reply from server-sent events: deltas in order, the last finish reason and usage."""
    events = list(events_of(lines))
    choices = [c for e in events for c in (e.get("choices") or [])[:1]]
    last = lambda values: next((v for v in reversed(list(values)) if v), None)
    usage = last(e.get("usage") for e in events) or {}
    content = "".join((c.get("delta") or {}).get("content") or "" for c in choices)
    return Reply(content, last(c.get("finish_reason") for c in choices), usage.get("prompt_tokens"), usage.get("completion_tokens"))


def is_local(url: str) -> bool:
    return (urllib.parse.urlsplit(url).hostname or "") in ("localhost", "127.0.0.1", "::1", "0.0.0.0")


@dataclass
class HttpBackend:
    """A chat endpoint over HTTP, with retries of what may pass."""

    timeout: float = 95.0
    local_timeout: float = 600.0  # a server on this machine may queue for long
    max_attempts: int = 3
    backoff_max: float = 60.0
    scheme: str = "bearer"
    stream: bool = False
    options: dict = field(default_factory=lambda: {"temperature": 0.0, "max_tokens": 96})

    def backoff(self, attempt: int) -> float:
        return min(self.backoff_max, 2.0**attempt) * random.uniform(0.5, 1.0)

    def request(self, endpoint: Endpoint, path: str, body: dict | None = None) -> urllib.request.Request:
        key = {endpoint.key_header: endpoint.api_key} if endpoint.key_header else {"Authorization": authorization(endpoint.api_key, self.scheme)}
        headers = {"Content-Type": "application/json"} | (key if endpoint.api_key else {}) | endpoint.headers
        data = None if body is None else json.dumps(body).encode()
        return urllib.request.Request(join_url(endpoint.base_url, path), data, {k: v for k, v in headers.items() if v})

    def patience(self, endpoint: Endpoint) -> float:
        return max(self.timeout, self.local_timeout) if is_local(endpoint.base_url) else self.timeout

    def models(self, endpoint: Endpoint) -> list[str]:
        """The models that a server lists."""
        with urllib.request.urlopen(self.request(endpoint, endpoint.models_path), timeout=30) as got:
            return [m["id"] for m in json.load(got)["data"]]

    def waiting(self, endpoint: Endpoint, path: str = "/metrics", name: str = "num_requests_waiting") -> float:
        """How many requests a server has queued, by the gauge of that name on its metrics page."""
        root = "{0.scheme}://{0.netloc}".format(urllib.parse.urlsplit(endpoint.base_url))
        with urllib.request.urlopen(join_url(root, path), timeout=30) as got:
            page = got.read().decode()
        return sum(float(line.split()[-1]) for line in page.splitlines() if line.partition("{")[0].split(" ")[0].endswith(name))

    def once(self, endpoint: Endpoint, body: dict) -> Reply:
        request = self.request(endpoint, endpoint.chat_path, body)
        try:
            with urllib.request.urlopen(request, timeout=self.patience(endpoint)) as got:
                if self.stream:
                    return stream_text(x.decode().strip() for x in got)
                data = json.load(got)
            choice, usage = data["choices"][0], data.get("usage") or {}
            return Reply(choice["message"]["content"], choice.get("finish_reason"), usage.get("prompt_tokens"), usage.get("completion_tokens"))
        except urllib.error.HTTPError as e:
            return Reply(error_class=class_of_status(e.code), error_detail=f"HTTP {e.code}: {e.read()[:200]!r}")
        except TimeoutError as e:
            return Reply(error_class="timeout", error_detail=str(e)[:200])
        except OSError as e:
            return Reply(error_class="timeout" if "timed out" in str(e) else "down", error_detail=str(e)[:200])
        except (ValueError, KeyError, IndexError, TypeError) as e:
            return Reply(error_class="retry", error_detail=f"not a chat reply: {e}"[:200])

    def __call__(self, system: str, user: str, contract: Contract, endpoint: Endpoint) -> Reply:
        body = request_body(endpoint, system, user, contract, self.options | ({"stream": True, "stream_options": {"include_usage": True}} if self.stream else {}))
        for attempt in range(1, self.max_attempts + 1):
            reply = self.once(endpoint, body)
            if reply.error_class in (None, "auth", "bad_request") or attempt == self.max_attempts:
                break
            time.sleep(self.backoff(attempt))
        reply.attempts = attempt
        return reply


def preflight(backend: Backend, prompt: Prompt, user: str, endpoint: Endpoint, guided: bool) -> None:
    """Refuses an endpoint that doesn't serve its model or, guided, doesn't heed a schema.

    One message is sent with a schema that pins the label to a text no model would choose. A reply
    that was cut off proves nothing, and neither does an unguided one.
    """
    contract = prompt.contract
    if endpoint.models_path:
        try:
            served = backend.models(endpoint)
        except (OSError, ValueError, KeyError, TypeError) as e:
            raise ConfigError(f"{endpoint.name}: no list of models ({e})") from None
        if endpoint.model not in served:
            raise ConfigError(f"{endpoint.name} doesn't serve {endpoint.model!r} but {', '.join(served)}")
    guided = guided and not contract.prose
    pinned = replace(contract, schema=contract.canary_schema()) if guided else contract
    reply = backend(prompt.system, user, pinned, endpoint)
    if reply.error_class:
        raise ConfigError(f"{endpoint.name}: the canary failed with {reply.error_class}: {reply.error_detail}")
    if not guided or reply.finish_reason == "length":
        return
    try:
        answer = json.loads(reply.content or "")
    except ValueError:
        answer = None
    if not isinstance(answer, dict) or answer.get(contract.canary_key) != CANARY:
        raise ConfigError(f"{endpoint.name} ignores the schema: {(reply.content or '')[:120]!r}")
    if tuple(answer) != contract.order:
        raise ConfigError(f"{endpoint.name} doesn't keep the schema's order of keys: {', '.join(answer)}")


#: Replies that a task holds before it hands them on, and that a journal's file takes.
HANDED, JOURNALLED = 64, 8


def in_lanes(plan: DataFrame, endpoints: list[Endpoint], tasks: int) -> tuple[DataFrame, dict[str, int]]:
    """The plan dealt into lanes, one endpoint each, and how many requests a lane may have in flight.

    An endpoint of concurrency c has min(c, tasks) lanes of floor(c / lanes) requests, each lane in one
    partition, so that all tasks together never exceed what was declared.
    """
    first, lane, width = 0, None, {}
    for e in endpoints:
        lanes = max(1, min(e.concurrency, tasks))
        width[e.name] = max(1, e.concurrency // lanes)
        number = F.lit(first) + F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int")
        lane = (F if lane is None else lane).when(F.col("endpoint") == e.name, number)
        first += lanes
    return plan.withColumn("__lane", lane).repartitionById(first, F.col("__lane")), width


class Journal:
    """Replies of a lane as they come, in small whole files that any later attempt at the lane's rows reads.

    So a task that is run again, or a run that is started again, pays only for what was not recorded.
    """

    def __init__(self, uri: str):
        self.files, self.path = FileSystem.from_uri(uri)
        self.files.create_dir(self.path, recursive=True)
        self.held: list[dict] = []

    def known(self) -> dict[str, list]:
        """What all attempts before this one have recorded, by key."""
        found = {}
        for info in self.files.get_file_info(FileSelector(self.path)):
            if info.path.endswith(".jsonl"):
                with self.files.open_input_stream(info.path) as lines:
                    found |= {r["key"]: r["reply"] for r in map(json.loads, lines.read().splitlines())}
        return found

    def add(self, key: str, reply: tuple) -> None:
        self.held.append({"key": key, "reply": reply})
        if len(self.held) >= JOURNALLED:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        part = f"{self.path}/{uuid.uuid4().hex}"
        with self.files.open_output_stream(part) as out:
            out.write("".join(json.dumps(r) + "\n" for r in self.held).encode())
        self.files.move(part, f"{part}.jsonl")
        self.held = []


def ask(plan: DataFrame, system: str, contract: Contract, backend: Backend, endpoints: list[Endpoint], journal: str | None = None) -> DataFrame:
    """``plan`` (with ``key``, ``user`` and ``endpoint``) and the replies.

    A ``local`` backend is called row by row, a batch of rows at a time. Of any other no endpoint ever has more requests in flight than its concurrency, over all
    tasks (but for tasks that Spark runs twice at a time, as in speculation). A slow row holds no other: replies
    are handed on as they come. An exception in one row becomes that row's error; replies cut off at the length limit are errors as well.

    ``journal`` names a folder that all tasks share, in which replies are kept until they are committed;
    what it holds is not asked again.
    """
    known = {e.name: e for e in endpoints}
    fields = [c.split() for c in REPLY.split(", ")]
    schema = plan.schema.simpleString()[len("struct<") : -1]
    columns, local, names = plan.columns, getattr(backend, "local", False) and not journal, [f[0] for f in fields]
    if getattr(backend, "local", False):
        width = {e.name: max(1, e.concurrency) for e in endpoints}
    else:
        plan, width = in_lanes(plan, endpoints, plan.sparkSession.sparkContext.defaultParallelism)

    def one(user: str, name: str) -> tuple:
        began = time.monotonic()
        try:
            reply = backend(system, user, contract, known[name])
        except Exception as e:
            reply = Reply(error_class="internal", error_detail=f"{type(e).__name__}: {e}"[:300])
        if reply.error_class is None and reply.finish_reason == "length":
            reply.error_class, reply.error_detail = "length", "the reply was cut off"
        took = round(time.monotonic() - began, 3)
        return reply.content, reply.finish_reason, took, reply.prompt_tokens, reply.completion_tokens, reply.error_class, reply.error_detail, getattr(reply, "attempts", 1)

    def table(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=[*columns, *names])
        for name in ("prompt_tokens", "completion_tokens"):
            made[name] = made[name].astype("Int64")
        return made

    def here(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies = table([one(*row) for row in zip(batch["user"], batch["endpoint"])], [])
            yield pd.concat([batch[columns].reset_index(drop=True), replies], axis=1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch[columns].itertuples(index=False, name=None))
        key, user, name = (columns.index(c) for c in ("key", "user", "endpoint"))
        pools = {n: ThreadPoolExecutor(w) for n, w in width.items()}  # threads start as they are needed
        pending: dict[Future, tuple] = {}
        done: list[tuple] = []
        log, before = None, {}
        if journal:
            log = Journal(journal)
            before = log.known()
        try:
            for row in rows:
                if (old := before.get(row[key])) is not None:
                    done.append((*row, *old))
                else:
                    pending[pools[row[name]].submit(one, row[user], row[name])] = row
                while len(pending) >= 2 * width[row[name]]:
                    done += taken(pending, log, key)
                if len(done) >= HANDED:
                    yield table(done, columns)
                    done = []
            while pending:
                done += taken(pending, log, key)
            if log:
                log.flush()
            if done:
                yield table(done, columns)
        finally:
            for pool in pools.values():
                pool.shutdown(cancel_futures=True)

    def taken(pending: dict[Future, tuple], log: Journal | None, key: int) -> list[tuple]:
        """The rows whose replies have come, at least one, taken out of ``pending``."""
        ready, _ = wait(pending, return_when=FIRST_COMPLETED)
        out = []
        for f in ready:
            row, reply = pending.pop(f), f.result()
            if log:
                log.add(row[key], reply)
            out.append((*row, *reply))
        return out

    return plan.mapInPandas(here if local else run, f"{schema},{','.join(':'.join(f) for f in fields)}")
