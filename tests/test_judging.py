"""Contracts, sources, sampling and whole runs on small inputs."""

import collections
import hashlib
import json
import threading
import time
import uuid
from dataclasses import replace
from datetime import datetime, timezone
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from gaugemill import catalogue
from gaugemill.functions import contract as contracts
from gaugemill.functions import parse, template
from gaugemill.operators import log, sampling, summary
from gaugemill.plans import backends, plan
from gaugemill.plans.judge import Options, judge, judge_folder, preview, request_example, run_id, taken_over
from gaugemill.sources import config, sinks
from gaugemill.sources import items as sources
from gaugemill.streaming import mirror as mirrors
from gaugemill.streaming import streams
from pyspark.sql import functions as F

SYSTEM = 'Judge the row.\n{"verdict": "consistent" | "inconsistent", "short_reason": "<why>"}'
USER = "colour: {colour}\nshape: {shape}\nsize: {size}"
PROMPT = contracts.build_prompt("p", SYSTEM, USER)
RULED = backends.RuleBackend(rules=((("colour: red", "shape: disc"), "inconsistent"),), refuse="shape: torn")
ENDPOINTS = [config.Endpoint("a", "m", concurrency=2), config.Endpoint("b", "m", concurrency=1)]


@pytest.fixture
def items(spark):
    rows = [(f"t:{i}", json.dumps({"colour": "red" if i % 3 == 0 else "blue", "shape": "torn" if i == 5 else "disc", "size": i}), "kept", "s", 2.0) for i in range(20)]
    return spark.createDataFrame(rows, "id string, fields_json string, group string, stratum string, weight double")


def test_contract_shapes():
    c = contracts.read_contract('Say\n{"n": 1 | 2, "x": [{"c": "<t>"}], "ok": true, "why": <text>}\nend')
    assert c.order == ("n", "x", "ok", "why") and c.label == "n" and c.values == (1, 2)
    assert c.spark_type().simpleString() == "struct<n:double,x:array<struct<c:string>>,ok:boolean,why:string>"
    assert contracts.read_contract("Just talk.").prose
    assert c.canary_schema()["properties"]["n"] == {"type": "string", "enum": [contracts.CANARY]}
    inner = 'Note {x}\n  {"a": "}" | "{",\n   "b": [1]}\nthen'
    assert contracts.read_contract(inner).values == ("}", "{")
    assert contracts.read_contract('{not one} for show\n```Answer\n{"b": 1 | 2}').order == ("b",)
    two = '{"a": 1}\ntext\n```answer\n{"b": "x" | "y"}\n```'
    assert contracts.read_contract(two).order == ("b",)


@pytest.mark.parametrize("text", ['{"a": 1}\n{"b": 2}', '{"a": []}', '{"a": ["x" | "y"]}', '{"a": }', '{"b": "x", "a": "y"}\nwrite "a" FIRST'])
def test_contract_refusals(text):
    with pytest.raises(contracts.ContractError):
        contracts.read_contract(text)


def test_parsers():
    c = PROMPT.contract
    good = parse.parse_strict('{"short_reason": "r", "verdict": " CONSISTENT"}', c)
    assert good["verdict"] == "consistent" and good["key_order_ok"] is False
    for bad in ("", "[1]", "null", '{"verdict": "consistent"}', '{"verdict": "no", "short_reason": ""}', '{"verdict": "consistent", "short_reason": ""} x'):
        assert parse.parse_strict(bad, c)["parse_error"]
    told = parse.parse_tolerant('<unused94>{"verdict": 1}<unused95>So {"verdict": "inconsistent", "short_reason": "x"} end', c)
    assert told["verdict"] == "inconsistent" and told["reasoning"] == "So" and told["parse_note"] is None
    assert parse.parse_tolerant('<unused94>{"verdict": "consistent", "short_reason": ""}', c)["parse_note"] == parse.UNCLOSED
    last = parse.parse_tolerant('{"verdict": "inconsistent", "short_reason": "1"} {"verdict": "consistent", "short_reason": "{2"} {"x": 1}', c)
    assert last["verdict"] == "consistent" and parse.parse_tolerant("<unused94>a<unused95>b<unused94>c<unused95>{", c)["parse_error"].endswith(": b{")
    numbers = contracts.read_contract('{"score": 1 | 2 | 3}')
    assert parse.parse_strict('{"score": 2.0}', numbers)["verdict"] == "2" and parse.parse_strict('{"score": true}', numbers)["parse_error"]


def test_parser_in_sql(spark):
    parse.register(spark, PROMPT.contract)
    row = spark.sql("""SELECT parse_reply('{"verdict": "consistent", "short_reason": "x"}').verdict AS v""").first()
    assert row.v == "consistent"


def test_run_resume_and_retry(spark, items, tmp_path):
    out = str(tmp_path / "run")
    first = judge(items, out, PROMPT, ENDPOINTS, RULED, options=Options(limit=12))
    assert first.count() == 12
    whole = judge(items, out, PROMPT, ENDPOINTS, RULED)
    assert whole.count() == 20 and whole.select("key").distinct().count() == 20
    assert judge(items, out, PROMPT, ENDPOINTS, RULED).count() == 20
    again = judge(items, out, PROMPT, ENDPOINTS, RULED, options=Options(retry_errors=True))
    assert again.count() == 21 and log.latest(again).count() == 20
    verdicts = {r.id: r.verdict for r in log.latest(again).collect()}
    assert verdicts["t:0"] == "inconsistent" and verdicts["t:1"] == "consistent" and verdicts["t:5"] is None
    doc = summary.document(log.latest(again), ["consistent", "inconsistent"], planned=20)
    assert doc["missing"] == 0 and doc["errors_by_class"] == {"bad_request": 1} and doc["by_group"]["kept"]["judged"] == 19


def test_retries_supersede_errors(spark, items, tmp_path):
    """Records of a later run come behind all earlier ones, also where the pool has grown in between."""
    out, sound = str(tmp_path / "r"), backends.RuleBackend(refuse="")
    failed = judge(items, out, PROMPT, ENDPOINTS, backend=lambda *a: backends.Reply(error_class="timeout"))
    assert failed.where("error.class = 'timeout'").count() == 20
    grown = items.union(spark.createDataFrame([("late:0", json.dumps({"colour": "blue", "shape": "cube", "size": 1}), "kept", "new", 1.0)], items.schema))
    again = judge(grown, out, PROMPT, ENDPOINTS, backend=sound, options=Options(retry_errors=True))
    last = log.latest(again)
    assert again.count() == 41 and last.count() == 21 and last.where("error is not null").count() == 0
    assert plan.done_keys(again, retry_errors=True).count() == 21 and again.select("seq").distinct().count() == 41
    assert judge(grown, out, PROMPT, ENDPOINTS, backend=sound, options=Options(retry_errors=True)).count() == 41
    doc = sinks.read_json(spark, f"{out}/_run/summary.json")
    assert doc["errors"] == 0 and doc["planned"] == 21 and doc["missing"] == 0
    manifest = sinks.read_json(spark, f"{out}/_run/manifest.json")
    assert [s["items_rows"] for s in manifest["sessions"]] == [20, 21, 21] and manifest["items_rows"] == 21
    order = spark.read.csv(f"{out}/_run/order", header=True).collect()
    assert sorted(int(r.order) for r in order) == list(range(21)) and sinks.read_text(spark, f"{out}/_run/prompt/user.md") == USER


def test_changed_runs_are_refused(items, tmp_path):
    out = str(tmp_path / "r")
    first = judge(items, out, PROMPT, ENDPOINTS, RULED, options=Options(limit=3, decoding={"max_tokens": 9, "temperature": 0}))
    assert first.count() == 3
    for prompt, options in (
        (contracts.build_prompt("p", SYSTEM, USER + "!"), Options(decoding={"temperature": 0})), (PROMPT, Options(decoding={"temperature": 1})), (PROMPT, Options(seed=1, decoding={"temperature": 0})),
    ):
        with pytest.raises(config.ConfigError):
            judge(items, out, prompt, ENDPOINTS, RULED, options=options)
    assert judge(items, out, PROMPT, ENDPOINTS, RULED, options=Options(decoding={"max_tokens": 99, "temperature": 0})).count() == 20


def test_endpoints_that_never_parse_are_refused(items, tmp_path):
    out = str(tmp_path / "r")
    many = items.union(items.withColumn("id", F.concat("id", F.lit("x"))))
    with pytest.raises(config.ConfigError, match="first 5 replies of a, b"):
        judge(many, out, PROMPT, ENDPOINTS, backend=lambda *a: backends.Reply("none", "stop"), options=Options(probe=5))
    assert items.sparkSession.read.parquet(out).count() == 10


class Server(BaseHTTPRequestHandler):
    """A chat server that heeds schemas or not, as its ``mood`` says."""

    mood, seen = "heeds", []

    def reply(self, body, kind="application/json"):
        self.send_response(200)
        self.send_header("Content-Type", kind)
        self.end_headers()
        self.wfile.write(body.encode())

    def do_GET(self):
        self.reply(json.dumps({"data": [{"id": "m"}]}) if self.path == "/v1/models" else 'x:num_requests_waiting{a="1"} 2.0\nx:num_requests_waiting{a="2"} 3\ny 7')

    def do_POST(self):
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Server.seen.append((asked, dict(self.headers)))
        schema = asked["response_format"]["json_schema"]["schema"]["properties"]
        answer = {k: (v["enum"][0] if self.mood != "ignores" else "consistent") if "enum" in v else "why" for k, v in schema.items()}
        answer = dict(reversed(answer.items())) if self.mood == "reorders" else answer
        text = "So: yes" if self.mood == "talks" else json.dumps(answer)
        usage = {"prompt_tokens": 3, "completion_tokens": 5}
        if not asked.get("stream"):
            return self.reply(json.dumps({"choices": [{"message": {"content": text}, "finish_reason": "stop"}], "usage": usage}))
        chunks = [{"choices": [{"delta": {"content": c}}]} for c in (text[:7], text[7:])] + [{"choices": [{"delta": {}, "finish_reason": "stop"}]}]
        chunks += [{"choices": [], "usage": usage}] if asked.get("stream_options", {}).get("include_usage") else []
        self.reply("".join(f"data: {json.dumps(c)}\n\n" for c in chunks) + "data: [DONE]\n\n", "text/event-stream")

    def log_message(self, *a):
        pass


@pytest.fixture
def served():
    with ThreadingHTTPServer(("127.0.0.1", 0), Server) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        Server.mood, Server.seen = "heeds", []
        yield config.Endpoint("s", "m", f"http://127.0.0.1:{server.server_port}/v1", api_key="k", key_header="x-api-key")
        server.shutdown()


def test_preflight_and_streams(items, served, tmp_path):
    few = items.limit(4)
    done = judge(few, str(tmp_path / "a"), PROMPT, [served], backend=backends.HttpBackend(stream=True)).collect()
    assert {(r.verdict, r.prompt_tokens, r.completion_tokens, r.error) for r in done} == {("consistent", 3, 5, None)}
    assert len(Server.seen) == 5 and all(h["X-Api-Key"] == "k" and "Authorization" not in h for _, h in Server.seen)  # the canary, and four rows
    assert Server.seen[0][0]["response_format"]["json_schema"]["schema"]["properties"]["verdict"]["enum"] == [contracts.CANARY]
    for n, mood in enumerate(("ignores", "reorders", "talks")):
        Server.mood, Server.seen = mood, []
        with pytest.raises(config.ConfigError):
            judge(few, str(tmp_path / mood), PROMPT, [served], backend=backends.HttpBackend())
        assert len(Server.seen) == 1  # nothing of the pool was sent
    with pytest.raises(config.ConfigError, match="doesn't serve"):
        judge(few, str(tmp_path / "b"), PROMPT, [replace(served, model="other")], backend=backends.HttpBackend())
    assert backends.HttpBackend().waiting(served) == 5
    assert sinks.read_json(items.sparkSession, f"{tmp_path}/a/_run/manifest.json")["sessions"][0]["waiting"] == {"s": 5}
    example = request_example(few, PROMPT, [served])
    assert example["model"] == "m" and example["messages"][1]["content"].startswith("colour: ")


def test_compare_limits_and_preview(spark, items, tmp_path):
    both = judge(items, str(tmp_path / "c"), PROMPT, ENDPOINTS, RULED, options=Options(mode="compare", max_requests=7))
    assert both.count() == 7
    assert preview(items, PROMPT, ENDPOINTS).first().user.startswith("colour: ")
    failing = judge(items, str(tmp_path / "f"), PROMPT, ENDPOINTS, backend=lambda *a: 1 / 0)
    assert {r.error["class"] for r in failing.collect()} == {"internal"}


def test_parts_cover_the_order(items):
    order = plan.send_order(items).cache()
    for n in (1, 3, 7):
        parts = [[r.ord for r in plan.part_of(order, f"{k}/{n}").collect()] for k in range(1, n + 1)]
        assert sorted(sum(parts, [])) == list(range(20)) and max(map(len, parts)) - min(map(len, parts)) <= 1
    for bad in ("2", "0/4", "5/4", "-1/4", "a/b", "1/2/3", "1/0"):
        with pytest.raises(config.ConfigError):
            plan.part_of(order, bad)


def test_sampling_from_files(spark, tmp_path):
    rows = "age,label,note\n" + "".join(f"{40 + i},{i % 2},x\n" for i in range(20))
    kept = lambda i: "1,accept," if i < 12 else "0,reject," + ("kb.sex" if i < 16 else "kb.age")
    (tmp_path / "t.csv").write_text("﻿" + rows)
    (tmp_path / "d.csv").write_text("index,kept,decision,checks\n" + "".join(f"{i},{kept(i)}\n" for i in range(20)))
    raw = {
        "tables": {"t": {"rows": "t.csv", "attrs": "d.csv"}},
        "groups": {
            "kept": {"table": "t", "select": {"kept": "1"}, "stratum": "label={label}"},
            "positive": {"table": "t", "alloc": "equal", "select": {"decision": "reject", "checks": ["kb.sex", "kb.age"]}, "stratum": "{checks}"},
        },
        "sizes": {"pilot": {"kept": 6, "positive": 4}},
    }
    spec = config.spec_of(raw, str(tmp_path))
    pool = sampling.make_items(spark, spec, config.pool_sizes(spec, "pilot"))
    got = pool.collect()
    assert len(got) == 10 and all(r.weight == 2.0 for r in got) and {r.stratum for r in got} == {"label=0", "label=1", "kb.sex", "kb.age"}
    assert all(list(json.loads(r.fields_json)) == ["age", "label", "note"] for r in got)
    assert [r.id for r in sampling.make_items(spark, spec, {"kept": 0}).collect()] == sorted(f"t:{i}" for i in range(12))
    (tmp_path / "d.csv").write_text("index,kept,decision,checks\n" + "".join(f"{i + 1},{kept(i)}\n" for i in range(20)))
    with pytest.raises(config.ConfigError):
        sampling.make_items(spark, spec, {"kept": 6})
    origin = sinks.provenance("spec", {"kept": 6}, 42, 10, {"t.csv": "sha"})
    sinks.write_items(pool.limit(0), str(tmp_path / "out"), origin)
    assert sinks.read_json(spark, str(tmp_path / "out" / "_items.json")) == origin


def test_item_sources_and_refusals(spark, tmp_path):
    (tmp_path / "i.csv").write_text('id,group,weight,age,note\nr1,heavy,70,5,"a\nb"\n,,,6,\n')
    got = sources.csv_items(spark, str(tmp_path / "i.csv")).collect()
    assert [r.id for r in got] == ["r1", "1"] and got[0].weight == 70.0 and got[1].weight is None and json.loads(got[1].fields_json) == {"age": "6", "note": ""}
    lines = ['{"id": "a", "fields": {"x": 1}}', "", '{"id": "a", "fields": {"x": 1}}', "not JSON", '{"id": "c"}', '{"id": "d", "fields": {"x": 2}, "weight": null}', '{"id": "e", "fields": {}}']
    (tmp_path / "i.jsonl").write_text("\n".join(lines))
    numbered = sources.jsonl_items(spark, str(tmp_path / "i.jsonl"), numbered=True)
    assert {r.problem: r.example for r in sources.problems(numbered).collect()}["id is empty"] == "line 4"
    (tmp_path / "f").mkdir()
    for n in ("a", "b", "x_pool"):
        (tmp_path / "f" / f"{n}.csv").write_text("id,age\n1,2\n3,4\n")
    folder = sources.read_folder(spark, str(tmp_path / "f"), breaks=False)
    assert sorted((r.file_name, r.id) for r in folder.collect()) == [("a.csv", "1"), ("a.csv", "3"), ("b.csv", "1"), ("b.csv", "3")]
    hashes = {r.file_name: (r.sha256, r.lines) for r in sources.hashed_files(spark, str(tmp_path / "f")).collect()}
    assert hashes["a.csv"] == (hashlib.sha256(b"id,age\n1,2\n3,4\n").hexdigest(), 3)
    (tmp_path / "p.system").write_text(SYSTEM)
    (tmp_path / "p.user").write_text(USER)
    assert config.load_prompt(str(tmp_path / "p.system"), str(tmp_path / "p.user")).sha == PROMPT.sha
    pool = sources.jsonl_items(spark, str(tmp_path / "i.jsonl"))
    found = {r.problem: r.rows for r in sources.problems(pool, ["x"]).collect()}
    assert found == {"id is repeated": 1, "id is empty": 1, "fields is no object": 2, "weight is no number": 1, "a placeholder's column is missing": 1}
    with pytest.raises(sources.ItemsError):
        sources.validated(pool)


def test_log_lines_are_read_whole(spark, tmp_path):
    whole = '{"key": "a", "n": [1, {"m": 2}]}'
    lines = [whole, "", "\t", whole[:-3], whole + whole, whole + " tail", whole + "}", whole + "]", whole + ', "x": 1', whole + ", " + whole, "[" + whole + "]", '"a"', "null", '{"n": 1}', '{"key": "b", "key": "c"}', f"  {whole} "]
    (tmp_path / "log.jsonl").write_text("\n".join(lines) + "\n")
    records, counts = sources.read_results(spark, str(tmp_path / "log.jsonl"))
    assert [(r.seq, r.key) for r in records.orderBy("seq").collect()] == [(0, "a"), (14, "c"), (15, "a")]
    assert counts.first().asDict() == {"lines": 3, "unreadable_lines": 11}
    (tmp_path / "none.jsonl").write_text("")
    records, counts = sources.read_results(spark, str(tmp_path / "none.jsonl"))
    assert records.count() == 0 and counts.first().asDict() == {"lines": 0, "unreadable_lines": 0}


def test_config_readers():
    assert config.env_lines("# c\nexport A='x y'\nB=2") == {"A": "x y", "B": "2"}
    assert config.join_url("http://h/v1?k=1", "/chat") == "http://h/v1/chat?k=1" and config.with_version("http://h:1") == "http://h:1/v1"
    assert config.header("A: b") == ("A", "b")
    assert [e.name for e in config.endpoints_of({"endpoint": [{"name": "a", "model": "m"}, {"name": "b", "model": "m", "enabled": False}]})] == ["a"]
    with pytest.raises(config.ConfigError):
        config.endpoints_of({"endpoint": [{"name": "a", "model": "m"}]}, only=["z"])
    old = {"prompt_sha": "1", "decoding": {"max_tokens": 1, "temperature": 0}}
    assert sinks.check_manifest(old, {"prompt_sha": "1", "items_rows": 7, "decoding": {"max_tokens": 2, "temperature": 0}}, {"session": "s"})["sessions"] == [{"session": "s"}]
    for change in ({"prompt_sha": "2"}, {"decoding": {"max_tokens": 1, "temperature": 1}}, {"mode": "compare"}):
        with pytest.raises(config.ConfigError):
            sinks.check_manifest(old, old | change, {})
    one = config.single_endpoint("m", "models.example:8000", "k", ("x-team: a",), key_header="api-key")
    assert (one.name, one.base_url, one.headers, one.key_header) == ("models.example:8000", "https://models.example:8000/v1", {"x-team": "a"}, "api-key")
    with pytest.raises(config.ConfigError):
        config.endpoints_of({"endpoint": [{"name": "a", "model": "m", "url_key": "NO_SUCH_URL"}]})
    assert config.endpoints_of({"endpoint": [{"name": "a", "model": "m", "url_key": "U", "key_key": "K"}]}, env={"U": "http://h", "K": "s"})[0].api_key == "s"
    assert backends.is_local("http://127.0.0.1:8/v1") and backends.HttpBackend().patience(config.Endpoint("a", "m", "http://localhost:1")) == 600
    assert run_id(datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc), "x") == "20240506T070809Z-x"
    with pytest.raises(config.ConfigError):
        run_id(tag="../x")
    assert backends.stream_text([": hi", "data: no JSON", "", 'data: {"choices": []}', "data: [1]"]).content == ""
    assert backends.stream_text(['data: {"choices":[{"delta":{"content":"a"}}]}', 'data: {"choices":[{"delta":{},"finish_reason":"stop"}],"usage":{"prompt_tokens":1,"completion_tokens":2}}', "data: [DONE]"]).content == "a"
    assert backends.class_of_status(418) == "retry" and backends.class_of_status(524) == "timeout"


def test_rendering(spark):
    row = spark.createDataFrame([('{"a": 63.0, "b": [1, 2], "c": null, "d": "  "}',)], "f string")
    got = row.select(template.render_json("{a}|{b}|{c}|{d}|{e}", F.col("f"))).first()[0]
    assert got == "63|[1,2]|<missing>|<missing>|<missing>" or got == "63|[1, 2]|<missing>|<missing>|<missing>"


def mirrored_bytes(target, name):
    parts = sorted(p for p in (target / name).iterdir() if p.name.isdigit())
    assert all(int(p.name) == sum(q.stat().st_size for q in parts[:i]) for i, p in enumerate(parts))  # nothing twice, nothing left out
    return b"".join(p.read_bytes() for p in parts)


def test_mirror_of_growing_logs(spark, tmp_path):
    source, target = tmp_path / "source", tmp_path / "target"
    (source / "deep").mkdir(parents=True)
    log, other = source / "deep" / "r.jsonl", source / "summary.json"

    def run(state, piece=64):
        mirrors.mirror(spark, str(source), str(target), str(tmp_path / state), piece=piece).awaitTermination(60)

    log.write_text("".join(f"line {i}\n" for i in range(50)) + "torn")
    other.write_text("one")
    (source / "run.pid").write_text("1")
    (source / "empty.jsonl").write_text("")
    run("s")
    assert mirrored_bytes(target, "deep/r.jsonl") == log.read_bytes() and (target / "summary.json").read_text() == "one" and not (target / "run.pid").exists()
    stamps = {p: p.stat().st_mtime_ns for p in target.rglob("*") if p.is_file()}
    run("s")
    run("fresh")  # a stream that knows nothing but the target
    assert {p: p.stat().st_mtime_ns for p in target.rglob("*") if p.is_file()} == stamps
    with log.open("a") as f:
        f.write(" line goes on\n" + "x" * 500 + "\n" + "".join(f"more {i}\n" for i in range(20)) + "torn again")
    other.write_text("two!")
    run("s")
    assert mirrored_bytes(target, "deep/r.jsonl") == log.read_bytes() and (target / "summary.json").read_text() == "two!"
    lines = [r.value for r in spark.read.text(str(target / "deep" / "r.jsonl")).collect()]
    assert sorted(lines) == sorted(log.read_text().splitlines()) and "torn line goes on" in lines  # no line is cut
    with log.open("a") as f:
        f.write("\nlast\n")
    run("other")
    assert mirrored_bytes(target, "deep/r.jsonl") == log.read_bytes()
    assert mirrors.verified(spark, str(source), str(target)).where("not same").isEmpty()
    # A batch that was broken off has left a part behind a gap, and a part that a larger one takes in.
    parts = sorted((target / "deep" / "r.jsonl").iterdir())
    parts[3].unlink()
    inner = log.read_bytes().index(b"\n", int(parts[3].name)) + 1
    (target / "deep" / "r.jsonl" / f"{inner:020d}").write_text("stale\n")
    run("s")
    assert mirrored_bytes(target, "deep/r.jsonl") == log.read_bytes()
    # A target that is ahead stays as it is, and so does what is there already on the way back.
    whole = log.read_bytes()
    log.write_bytes(whole[:100])
    run("s")
    assert mirrored_bytes(target, "deep/r.jsonl") == whole
    back = tmp_path / "back"
    (back / "deep").mkdir(parents=True)
    (back / "summary.json").write_text("mine")
    copied = {r.file: r.bytes for r in mirrors.restored(spark, str(target), str(back)).collect()}
    assert copied == {"deep/r.jsonl": len(whole)} and (back / "deep" / "r.jsonl").read_bytes() == whole and (back / "summary.json").read_text() == "mine"


def test_small_logs_share_a_task():
    pieces = [(n, mirrors.Piece(str(i))) for i, n in enumerate([3, 4, 5, 20, 0, 1, *[0] * 40])]
    tasks = mirrors.packed(pieces, 10)
    assert [p.file for t in tasks for p in t.pieces] == [str(i) for i in range(46)]
    assert [len(t.pieces) for t in tasks] == [2, 1, 1, 32, 10] and not mirrors.packed([], 10)


def test_a_run_is_taken_over_from_its_mirror(spark, items, tmp_path):
    here, remote, home = (str(tmp_path / n) for n in ("here", "remote", "home"))
    first = judge(items, here, PROMPT, ENDPOINTS, RULED, options=Options(limit=12, session="one")).collect()
    mirrors.mirror(spark, here, remote, str(tmp_path / "state")).awaitTermination(60)
    out = taken_over(spark, remote, home)
    assert taken_over(spark, remote + "/", home) != here and taken_over(spark, remote, home) == out  # again: nothing is lacking
    done = judge(items, out, PROMPT, ENDPOINTS, RULED, options=Options(session="two"))
    assert done.count() == 20 == done.select("key").distinct().count()
    assert sorted(r.key for r in done.where("session = 'one'").collect()) == sorted(r.key for r in first)
    assert [s["session"] for s in sinks.read_json(spark, f"{out}/_run/manifest.json")["sessions"]] == ["one", "two"]
    with pytest.raises(config.ConfigError, match="other values of seed"):
        judge(items, out, PROMPT, ENDPOINTS, RULED, options=Options(seed=7))


def test_summary_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", True), ("a", False)], "e string, bad boolean")
    rows.write.parquet(str(tmp_path / "in"))
    streams.summary_stream(spark, str(tmp_path / "in"), "e string, bad boolean", ["e"], F.col("bad"), str(tmp_path / "out"), str(tmp_path / "st2")).awaitTermination(60)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a", 2, 1)]


def csv_folder(folder, sizes):
    folder.mkdir()
    for name, n in zip("abc", sizes):
        (folder / f"{name}.csv").write_text("v\n" + "".join(f"{name}{i}\n" for i in range(n)))
    return str(folder)


def test_places_over_files_of_unlike_sizes(spark, tmp_path):
    """Splits are packed by size, so places must follow paths: also where the first file is the largest, or the smallest."""
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "part-1.jsonl").write_text('{"key": "k", "v": "old"}\n')
    (logs / "part-2.jsonl").write_text("".join(f'{{"key": "{i or "k"}", "v": "new"}}\n' for i in range(501)))
    records, counts = sources.read_results(spark, str(logs))
    assert [r.seq for r in records.orderBy("seq").collect()] == list(range(502)) and counts.first().lines == 502
    assert log.latest(records).where("key = 'k'").first().value.endswith('"new"}')
    for i, sizes in enumerate([(2, 300, 5), (300, 5, 2), (1, 1, 900)]):
        rows, attrs = (sources.read_table(spark, csv_folder(tmp_path / f"{side}{i}", sizes), breaks=False) for side in ("rows", "attrs"))
        joined = sampling.zipped(rows, attrs)
        assert sampling.mismatches(joined).isEmpty() and joined.where("row.v <> attr.v").isEmpty() and joined.count() == sum(sizes)
        got = [r.v for r in sources.positioned(rows).orderBy("pos").collect()]
        assert got == [f"{name}{k}" for name, n in zip("abc", sizes) for k in range(n)]


def test_zip_of_unlike_files_is_refused(spark, tmp_path):
    rows = sources.read_table(spark, csv_folder(tmp_path / "rows", (2, 300, 5)), breaks=False)
    other = sources.read_table(spark, csv_folder(tmp_path / "other", (300, 2, 5)), breaks=False)
    assert sampling.mismatches(sampling.zipped(rows, other)).count() == 2 * 298  # the whole has as many rows
    one = tmp_path / "one"
    one.mkdir()
    (one / "all.csv").write_text("v\n" + "".join(f"{name}{i}\n" for name, n in zip("abc", (2, 300, 5)) for i in range(n)))
    joined = sampling.zipped(rows, sources.read_table(spark, str(one)))
    assert sampling.mismatches(joined).isEmpty() and joined.where("row.v <> attr.v").isEmpty()


def test_places_need_files_in_order(spark, tmp_path):
    rows = sources.read_table(spark, csv_folder(tmp_path / "rows", (2, 300, 5)), breaks=False)
    with pytest.raises(sources.ItemsError, match="no places"):
        sources.positioned(rows.groupBy("v").count())
    assert sorted(r.pos for r in sources.positioned(spark.range(10).toDF("x")).collect()) == list(range(10))
    assert sources.positioned(rows.limit(0)).isEmpty() and sources.positioned(spark.createDataFrame([], "x int")).isEmpty()
    split = spark.read.option("maxPartitionBytes", "64").text(str(tmp_path / "rows"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        assert [r.value for r in sources.positioned(split).orderBy("pos").collect()][:4] == ["v", "a0", "a1", "v"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def timed(folder, seconds=0.05):
    """A backend that notes when each request began and ended, as a server would see it."""

    def answer(system, user, contract, endpoint):
        began = time.time()
        time.sleep(1.5 if "size: 3\n" in f"{user}\n" and seconds else seconds)
        (folder / f"{endpoint.name}-{uuid.uuid4().hex}").write_text(json.dumps([endpoint.name, began, time.time(), user.rpartition(" ")[2]]))
        return backends.Reply('{"verdict": "consistent", "short_reason": "x"}', "stop")

    return answer


def requests_of(folder):
    return [json.loads(f.read_text()) for f in folder.iterdir()]


def in_flight(requests, name):
    edges = sorted(e for n, a, b, _ in requests if n == name for e in ((a, 1), (b, -1)))
    now = most = 0
    for _, step in edges:
        now += step
        most = max(most, now)
    return most


@pytest.mark.parametrize("widths", [(1, 1), (4, 1), (7, 3)])
def test_requests_in_flight_never_exceed_the_concurrency(spark, items, tmp_path, widths):
    seen = tmp_path / "seen"
    seen.mkdir()
    endpoints = [config.Endpoint(n, "m", concurrency=w) for n, w in zip("ab", widths)]
    many = spark.range(120).select(F.col("id").cast("string").alias("key"), F.lit("size: 0").alias("user"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("endpoint")).repartition(9)
    done = backends.ask(many, "s", PROMPT.contract, timed(seen), endpoints).collect()
    assert sorted(int(r.key) for r in done) == list(range(120)) and {r.content[:10] for r in done} == {'{"verdict"'}
    found = requests_of(seen)
    assert len(found) == 120
    for name, width in zip("ab", widths):
        assert in_flight(found, name) <= width
    assert in_flight(found, "a") == widths[0] or widths[0] > 4  # and the declared number is used


def test_a_slow_row_holds_no_other(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    rows = spark.range(60).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("size: "), F.when(F.col("id") == 0, 3).otherwise(9)).alias("user"), F.lit("a").alias("endpoint")).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        backends.ask(rows, "s", PROMPT.contract, timed(seen), [config.Endpoint("a", "m", concurrency=2)]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = requests_of(seen)
    slow = next(r for r in found if r[3] == "3")
    assert sum(1 for r in found if slow[1] < r[2] < slow[2]) > 6  # more than the slow row's own batch


def test_a_task_that_is_run_again_pays_only_for_what_was_not_recorded(spark, items, tmp_path):
    """The first attempts fail half-way; what they recorded is read again, and the journal goes with the commit."""
    seen, out = tmp_path / "seen", str(tmp_path / "run")
    seen.mkdir()
    good = timed(seen, 0.0)

    def falls(system, user, contract, endpoint):
        if len(list(seen.iterdir())) >= 12 and not (tmp_path / "mended").exists():
            raise SystemExit  # the worker goes, as with a lost executor
        return good(system, user, contract, endpoint)

    one = [config.Endpoint("a", "m", concurrency=1)]
    with pytest.raises(Exception):
        judge(items, out, PROMPT, one, backend=falls, options=Options(preflight=False, probe=0))
    before = requests_of(seen)
    kept = [json.loads(line) for f in (tmp_path / "run" / "_run" / "journal" / "all").glob("*.jsonl") for line in f.read_text().splitlines()]
    assert len(before) == 12 and len(kept) == 8  # whole files of eight replies
    (tmp_path / "mended").write_text("")
    done = judge(items, out, PROMPT, one, backend=falls, options=Options(preflight=False, probe=0))
    assert done.count() == 20 and done.select("key").distinct().count() == 20 and {r.verdict for r in done.collect()} == {"consistent"}
    again = collections.Counter(r[3] for r in requests_of(seen))
    assert sum(again.values()) == 20 + (len(before) - len(kept)) and not (tmp_path / "run" / "_run" / "journal" / "all").exists()


def test_user_texts_are_templates(spark, items, tmp_path):
    """A template's rows and placeholders are no examples; a marked block is."""
    prose = contracts.build_prompt("p", "Describe the row in prose.", "Row:\n{colour}\n{a: 1}\n{shape}")
    assert prose.contract.prose
    marked = contracts.build_prompt("p", "", 'Row:\n{colour}\n```answer\n{"v": "a" | "b"}\n```')
    assert marked.contract.label == "v" and marked.contract.values == ("a", "b")
    plain = contracts.build_prompt("p", "Say what you see.", "colour: {colour}")
    with pytest.raises(config.ConfigError, match="guided=False"):
        judge(items, str(tmp_path / "g"), plain, ENDPOINTS)
    done = judge(items, str(tmp_path / "p"), plain, ENDPOINTS, options=Options(guided=False))
    assert done.count() == 20 and done.where("answer_json is null").isEmpty()


@pytest.mark.parametrize("bad", [{"limit": True}, {"seed": False}, {"run_tag": 3}, {"part": True}, {"probe": 1.5}, {"guided": 1}, {"max_requests": "9"}])
def test_options_of_the_wrong_kind_are_refused(bad):
    with pytest.raises(config.ConfigError, match="must be"):
        Options(**bad)


def test_endpoints_are_looked_up_by_names_in_order():
    entry = {"name": "a", "model": "m", "url_key": ["NEW_URL", "OLD_URL"], "key_key": ["NEW_KEY", "OLD_KEY"]}
    found = config.endpoint_of(entry, {"OLD_URL": "old.example", "NEW_KEY": "n", "OLD_KEY": "o"})
    assert found.base_url == "https://old.example/v1" and found.api_key == "n"
    assert config.endpoint_of(entry | {"base_url": "here.example"}, {"NEW_URL": "new.example"}).base_url == "https://here.example/v1"
    with pytest.raises(config.ConfigError, match="NEW_URL or OLD_URL"):
        config.endpoint_of(entry, {})
    assert config.first_set(["A", "B"], {"B": "env"}, {"A": "store"}.get) == "store" and config.first_set(["A"], {}, lambda name: None) == ""


def exchanges_over(plan_text, table):
    """How many exchanges of a physical plan stand above a scan of the table's files."""
    lines, found = plan_text.splitlines(), 0
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line:
            depth = line.index("FileScan")
            for above in reversed(lines[:i]):
                at = len(above) - len(above.lstrip(" :+-*()0123456789"))
                if at < depth:
                    depth, found = at, found + ("Exchange" in above)
    return found


def test_resume_shuffles_no_records(spark, items, tmp_path):
    out = str(tmp_path / "run")
    judge(items, out, PROMPT, ENDPOINTS, RULED, options=Options(limit=12))
    old = sinks.read_table_of(spark, out)
    assert old.count() == 12 == spark.read.parquet(out).count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for retry in (False, True):
            left = plan.remaining(items.select(F.col("id").alias("key")), plan.done_keys(old, retry))
            text = left._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" in text and exchanges_over(text, "bucketed") == 0 and "SelectedBucketsCount: 16 out of 16" in text.replace("\n", " ")
            assert "Exchange" not in plan.done_keys(old, retry)._jdf.queryExecution().executedPlan().toString()
            assert left.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert judge(items, out, PROMPT, ENDPOINTS, RULED).count() == 20 and not [t for t in spark.catalog.listTables() if t.name.startswith("gaugemill_")]


def test_overlapping_runs_record_each_key_once(spark, items, tmp_path):
    """Two runs that both started before the other recorded anything, and a third that retries errors."""
    out, meet = str(tmp_path / "run"), threading.Barrier(2, timeout=120)
    started = []

    def both(part):
        def work():
            judge(items, out, PROMPT, ENDPOINTS, RULED, options=Options(run_tag=part, probe=0))

        return threading.Thread(target=work, name=part)

    real = sinks.append_new
    import gaugemill.plans.judge as judging

    def waits(*args, **kwargs):
        meet.wait()  # both have planned the whole pool
        started.append(threading.current_thread().name)
        return real(*args, **kwargs)

    judging.append_new = waits
    try:
        runs = [both("one"), both("two")]
        [r.start() for r in runs]
        [r.join(240) for r in runs]
    finally:
        judging.append_new = real
    done = sinks.read_table_of(spark, out)
    assert sorted(started) == ["one", "two"] and done.count() == 20 == done.select("key").distinct().count() == done.select("seq").distinct().count()
    again = judge(items, out, PROMPT, ENDPOINTS, backends.RuleBackend(), options=Options(retry_errors=True))
    assert again.count() == 21 and log.latest(again).where("error is not null").isEmpty() and again.select("seq").distinct().count() == 21


def test_appending_streams_record_each_key_once(spark, tmp_path):
    out, source = str(tmp_path / "t"), str(tmp_path / "in")
    rows = lambda keys: spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "seq long, key string")
    for i, keys in enumerate((["a", "b", "a"], ["b", "c"])):
        rows(keys).write.mode("append").parquet(source)
        stream = spark.readStream.schema("seq long, key string").parquet(source)
        for state in (f"s{i}", "again"):  # a stream that has forgotten what it did, and one that goes on
            sinks.append_stream(stream, out, str(tmp_path / state)).awaitTermination(120)
    assert sorted(r.key for r in sinks.read_table_of(spark, out).collect()) == ["a", "b", "c"]


def test_locks(spark, tmp_path):
    path = str(tmp_path / "lock")
    with sinks.locked(spark, path):
        with pytest.raises(config.ConfigError, match="another run"):
            with sinks.locked(spark, path, patience=0.3):
                pass
        with sinks.locked(spark, path, patience=5, stale=-1):  # one that was left behind
            pass
    with sinks.locked(spark, path, patience=0):
        pass


def test_quantiles_of_any_values(spark):
    inf, nan = float("inf"), float("nan")
    groups = {
        "wide": [10.0**k for k in range(-300, 301, 7)], "signs": [-1e308, -5.0, 0.0, 5e-324, 1e308], "ends": [-inf, -inf, 1.0, inf, nan], "nan": [nan, nan, 1.0], "one": [3.5], "same": [2.0] * 50,
        "close": [1.0 + k * 2.0**-52 for k in range(40)], "none": [None, None], "inf": [inf, inf, inf, 0.0],
    }
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    ps = (0, 10, 50, 75, 100)
    got = {r.g: [r[f"v_p{p}"] for p in ps] for r in summary.quantiles(rows, ("g",), {"v": ps}).collect()}
    assert set(got) == set(groups) - {"none"}
    for g, found in got.items():
        own = sorted(groups[g], key=lambda v: (v != v, v))
        assert repr(found) == repr([own[round(p / 100 * (len(own) - 1))] for p in ps]), g


def test_one_scan_for_counts_rates_and_histograms(spark):
    rows = catalogue.results(spark, "/root/testdata/sf0.001")
    text = summary.cube(rows)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Expand") == 1
    doc = summary.document(rows, catalogue.VALUES, planned=300)
    assert doc["missing"] == 300 - doc["rows"] == 100
    for r in summary.rates(rows, catalogue.VALUES).collect():
        own = doc["by_group"][r.group]
        assert own["judged"] == r.judged and own["rates"][r.verdict] == pytest.approx(r.rate, abs=1e-4) and own["rates_weighted"][r.verdict] == pytest.approx(r.rate_weighted, abs=1e-4)
    for r in summary.by_endpoint(rows).collect():
        assert doc["by_endpoint"][r.endpoint] == r.asDict()
    assert {(g, s, v): n for g, own in doc["by_group"].items() for s, vs in own["by_stratum"].items() for v, n in vs.items()} == {(r.group, r.stratum, r.verdict): r.rows for r in summary.crosstab(rows).where("group is not null and stratum is not null").collect()}
    assert summary.document(rows.limit(0), catalogue.VALUES)["rows"] == 0


def test_two_tiers_parse_alike(spark):
    """Whatever a text is, built-ins and parsers say the same, and most well-formed replies never reach a worker."""
    contract = contracts.read_contract('{"verdict": "Consistent" | "not so", "short_reason": "<why>", "sure": true}')
    good = '{"verdict": "%s", "short_reason": "r é {} 日本", "sure": %s}'
    texts = [good % (v, s) for v in ("consistent", " NOT SO ", "Not so", "maybe", "ＣＯＮ", "consistent\t") for s in ("true", "false", "null", "1", "1.50", '"x"', "[1]", "{}", "NaN")]
    texts += [
        None, "", " ", "null", "[]", "3", '"x"', good, '{"short_reason": "a",\n "sure": true, "verdict" :"consistent"}', good % ("consistent", "true") + " tail", good % ("consistent", "true") + good % ("not so", "true"),
        '{"verdict": "consistent", "verdict": "not so", "short_reason": "x", "sure": true}', '{"verdict": "consistent", "short_reason": "a\\n\\"b", "sure": true}', '{"verdict": "consistent", "sure": true}',
        "{'verdict': 'consistent', 'short_reason': 'x', 'sure': true}", '{"verdict": "consistent", "short_reason": "a\nb", "sure": true}', "  " + good % ("consistent", "true") + "\n", '{"verdict": "consistent", "short_reason": null, "sure": true, "more": 1}',
        "<unused94>so<unused95>" + good % ("consistent", "true"), '{"verdict": "consistent", "short_reason": "<unused94>", "sure": true}', '{"verdict": "consistent", "short_reason": "x", "sure": true,}', '[' + good % ("consistent", "true") + "]", good % ("consistent", "true") + "]", '{"verdict": "consistent", "short_reason": "x", "sure": true} }',
        '﻿' + good % ("consistent", "true"), '{"verdict": "\\u0063onsistent", "short_reason": "x", "sure": true}', '{"verdict": {"verdict": "consistent"}, "short_reason": "x", "sure": true}', '{"verdict": "consistent", "short_reason": "x", "sure": true // no\n}', "I say " + good % ("not so", "false"),
    ]
    texts[texts.index(good)] = good % ("consistent", "tru")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    names = [c.split()[0] for c in parse.PARSED.split(", ")]
    for guided, use in ((True, parse.parse_strict), (False, parse.parse_tolerant)):
        got = rows.select("i", parse.parsed(F.col("t"), contract, guided).alias("p"), parse.proven(F.col("t"), contract).isNotNull().alias("sure")).collect()
        for r in got:
            want = use(texts[r.i] or "", contract)
            assert r.p.asDict() == {n: want.get(n) for n in names}, (texts[r.i], r.p, want)
        sure = {texts[r.i] for r in got if r.sure}
        assert good % (" NOT SO ", "false") in sure and good % ("maybe", "true") not in sure and len(sure) >= 14
    well = catalogue.replies(spark, "/root/testdata/sf0.001").where("doc_id % 5 = 0")
    assert well.where(parse.proven(F.col("content"), catalogue.CONTRACT).isNull()).isEmpty()


def test_hashes_of_files(spark, tmp_path):
    contents = {"a b.txt": b"x\ny\n", "ä.bin": bytes(range(256)) * 70000, "empty": b"", "no%20break": b"one"}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    got = {r.file_name: (r.sha256, r.lines) for r in sources.hashed_files(spark, str(tmp_path)).collect()}
    assert got == {n: (hashlib.sha256(d).hexdigest(), d.count(b"\n")) for n, d in contents.items()}


def test_one_run_over_a_folder_is_a_run_for_each_file(spark, tmp_path):
    folder = tmp_path / "pools"
    folder.mkdir()
    for name, n in (("small", 2), ("large", 60), ("mid", 9)):
        (folder / f"{name}.csv").write_text("id,colour,shape,size\n" + "".join(f"{'' if i % 2 else f'r{i}'},{'red' if i % 3 else 'blue'},disc,{i}\n" for i in range(n)))
    (folder / "x_pool.csv").write_text("id,colour,shape,size\nz,a,b,c\n")
    out, options = str(tmp_path / "all"), Options(limit=20)
    done = judge_folder(spark, str(folder), out, PROMPT, ENDPOINTS, RULED, options, breaks=False)
    fields = ("id", "key", "seq", "endpoint", "verdict", "short_reason", "weight")
    got = {n: sorted(tuple(r[f] for f in fields) for r in done.where(F.col("file_name") == f"{n}.csv").collect()) for n in ("small", "large", "mid")}
    for name in got:
        one = judge(sources.csv_items(spark, str(folder / f"{name}.csv")), str(tmp_path / name), PROMPT, ENDPOINTS, RULED, options)
        assert got[name] == sorted(tuple(r[f] for f in fields) for r in one.collect()), name
    assert {n: len(rows) for n, rows in got.items()} == {"small": 2, "large": 20, "mid": 9}
    # One file again, with other rules: only its records change.
    (tmp_path / "again").mkdir()
    (tmp_path / "again" / "mid.csv").write_text((folder / "mid.csv").read_text())
    after = judge_folder(spark, str(tmp_path / "again"), out, PROMPT, ENDPOINTS, backends.RuleBackend(otherwise="inconsistent"), options, breaks=False)
    assert {(r.file_name, r.verdict) for r in after.where("file_name = 'mid.csv'").collect()} == {("mid.csv", "inconsistent")} and after.count() == 31
    (tmp_path / "again" / "odd.csv").write_text("colour,id,shape,size\nred,q,disc,1\n")
    with pytest.raises(Exception):
        judge_folder(spark, str(tmp_path / "again"), out, PROMPT, ENDPOINTS, RULED, options, breaks=False)
    assert spark.read.parquet(out).count() == 31


def test_local_backends_need_no_threads(items):
    """Rules answer in the task itself; errors and replies that were cut off are still those of their rows."""

    class Where:
        local = True

        def __call__(self, system, user, contract, endpoint):
            import threading

            if "red" in user:
                raise ValueError(user)
            here = threading.current_thread() is threading.main_thread()
            return backends.Reply(str(here), "length" if "blue" in user else "stop", len(user))

    plan = items.selectExpr("id", "id AS key", "CASE WHEN id LIKE '%3' THEN 'red' WHEN id LIKE '%4' THEN 'blue' ELSE id END AS user").withColumn("endpoint", F.lit(ENDPOINTS[0].name))
    got = {r.id: r for r in backends.ask(plan, "", PROMPT.contract, Where(), ENDPOINTS).collect()}
    assert len(got) == items.count() and {r.error_class for r in got.values()} == {None, "internal", "length"}
    for r in got.values():
        assert r.error_class == {"red": "internal", "blue": "length"}.get(r.user) and r.content == (None if r.user == "red" else "True")
        assert r.prompt_tokens == (None if r.user == "red" else len(r.user)) and r.attempts == 1 and r.key == r.id


def test_a_summary_works_records_out_once(spark):
    rows, seen = catalogue.results(spark, "/root/testdata/sf0.001"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    doc = summary.document(rows.mapInPandas(counted, rows.schema), catalogue.VALUES)
    assert seen.value == doc["rows"] == rows.count()
    one = summary.document(rows.where("endpoint = 'a'"), catalogue.VALUES)
    assert one["agreement"] == [] and list(one["by_endpoint"]) == ["a"]
    two = summary.document(rows.unionByName(rows.withColumn("endpoint", F.lit("d"))), catalogue.VALUES)
    assert [(r["a"], r["b"]) for r in two["agreement"]] == [("a", "d"), ("b", "d"), ("c", "d")]
    kept = log.latest(catalogue.results(spark, "/root/testdata/sf0.001"), "id", columns=("id", "endpoint"))
    assert kept.columns == ["id", "endpoint"] and kept.count() == doc["rows"]
