"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from gaugemill import catalogue, file_queries

from oracle import by_spark, by_sql

FOLDER = "/root/testdata/sf0.001"


QUERIES, ORACLES = catalogue.QUERIES | file_queries.QUERIES, catalogue.ORACLES | file_queries.ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    ours, theirs = by_spark(QUERIES[name](spark, FOLDER)), by_sql(ORACLES[name], FOLDER)
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert entry.entry(spark).count() == 12


def test_streaming_summary_on_a_stream(spark, tmp_path):
    """Files of events, of which the last is late: windows that the watermark has closed keep their counts."""
    from gaugemill.streaming import streams

    at = lambda minute: f"2024-01-01 00:{minute:02d}:30"
    batches = [[(at(0), "a"), (at(1), "a"), (at(2), "b")], [(at(40), "a")], [(at(59), "b")], [(at(1), "a"), (at(58), "b")]]
    source, out = tmp_path / "in", str(tmp_path / "out")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "ts string, kind string").selectExpr("to_timestamp(ts) AS ts", "kind").coalesce(1).write.mode("append").parquet(str(source / f"d={i}"))
        stream = streams.progress(spark.readStream.schema("ts timestamp, kind string").parquet(str(source / "d=*")), ["kind"])
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(60)
    got = {(r.start.minute + 60 * r.start.hour, r.kind): r.rows for r in spark.read.parquet(out).where("start >= '2024-01-01' and start < '2024-01-01 00:40:00'").collect()}
    assert got[0, "a"] == 2 and got[1, "a"] == 1 and got[0, "b"] == 1 and got[36, "a"] == 1  # the late row of minute 1 isn't counted
    events = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "id string, n int")
    assert streams.deduplicated(events, ["id"]).count() == 2


def test_failures_on_a_stream(spark, tmp_path):
    """The same events as a table and in batches, late ones among them: the same streaks and refusals."""
    from gaugemill.operators import log
    from gaugemill.streaming import states
    from pyspark.sql import functions as F

    rows = [("a" if i % 3 else "b", 60_000_000 * (i + 1440) + i % 7, i, i % 5 > 0 if i > 9 else i % 3 > 0) for i in range(90)]
    kind = "endpoint string, micros long, id long, failed boolean"
    mixed = sorted(rows, key=lambda r: r[1] // 1_800_000_000 * 1_800_000_000 + (r[2] * 37 % 30) * 60_000_000)  # out of order within half an hour
    batches = [mixed[:25], mixed[25:50], mixed[50:], [("z", 60_000_000 * 9000, 9000, False)], [("z", 60_000_000 * 9001, 9001, False)]]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = lambda df: df.withColumn("ts", F.timestamp_micros("micros"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for batch in batches:
            spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(source)
            stream = states.failures(events(spark.readStream.schema(kind).parquet(source)), "endpoint", "ts", "id", F.col("failed"), first=3, late="2 hours")
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    table = spark.createDataFrame(rows, kind)
    want = {r.id: r.streak for r in log.streaks(table, ["endpoint"], ["micros", "id"], F.col("failed")).collect()}
    got = spark.read.parquet(out).where("endpoint <> 'z'")
    assert {r.tie: r.streak for r in got.collect()} == want and got.count() == len(rows)
    refused = {r.endpoint: r.refuse for r in log.first_all_failed(table, ["endpoint"], ["micros", "id"], F.col("failed"), 3).collect()}
    assert {r.endpoint: r.refuse for r in got.groupBy("endpoint").agg(F.max("refuse").alias("refuse")).collect()} == refused == {"a": True, "b": False}


def test_state_has_as_many_rows_as_parts(spark, tmp_path):
    """However many groups there are and events that wait; idle groups are dropped, and start anew."""
    from gaugemill.streaming import states
    from pyspark.sql import functions as F

    kind, minute = "endpoint string, micros long, id long, failed boolean", 60_000_000
    batches = [[(e, minute * (1440 + i), i, True) for e in "ab" for i in range(50)] + [(f"c{i}", minute * 1441, i, i % 2 == 0) for i in range(1500)], [("b", minute * 1500, 50, True)], [("b", minute * 6000, 51, False)], [("a", minute * 6001, 52, True), ("b", minute * 9000, 53, True)]]
    source, out, waiting = str(tmp_path / "in"), str(tmp_path / "out"), []
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for batch in batches:
            spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(source)
            events = spark.readStream.schema(kind).parquet(source).withColumn("ts", F.timestamp_micros("micros"))
            run = states.failures(events, "endpoint", "ts", "id", F.col("failed"), first=3, late="20 minutes").writeStream.format("parquet").option("path", out)
            run = run.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
            run.awaitTermination(120)
            waiting += [max(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"])]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert max(waiting) <= states.PARTS and waiting[-1] <= 2
    got = {(r.endpoint, r.tie): (r.streak, r.place, r.refuse) for r in spark.read.parquet(out).collect()}
    assert got == {(e, i): (i + 1, i + 1, i >= 2) for e in "ab" for i in range(50)} | {("b", 50): (51, 51, True), ("b", 51): (0, 52, True), ("a", 52): (1, 1, False)} | {(f"c{i}", i): (1 - i % 2, 1, False) for i in range(1500)}


def test_deduplicated_stream(spark, tmp_path):
    """Repeats of a key are dropped on a stream too, also across batches."""
    from gaugemill.streaming import streams
    from pyspark.sql import functions as F

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in ([("a", 1), ("a", 2), ("b", 3)], [("b", 4), ("c", 5)]):
        spark.createDataFrame(batch, "k string, s long").write.mode("append").parquet(source)
        events = spark.readStream.schema("k string, s long").parquet(source).withColumn("ts", F.timestamp_seconds("s"))
        streams.deduplicated(events, ["k"]).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(60)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_zipped_folders_are_cut_alike(spark):
    """More rows than the sample that ranges are taken from: both folders still have files of equal lengths."""
    folder = "/root/testdata/sf0.1"
    ours, theirs = by_spark(QUERIES["zip_places"](spark, folder)), by_sql(ORACLES["zip_places"], folder)
    assert len(ours[1]) == len(theirs[1]) and ours == theirs


def test_a_pool_of_a_folder_has_one_file_of_records(spark, tmp_path):
    """However many tasks judge a pool's rows, they don't each add a file to it."""
    from gaugemill.catalogue import ENDPOINTS, PROMPT, RULES
    from gaugemill.plans.judge import judge_folder

    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / "in" / f"{name}.csv").write_text("id,p_name,p_brand,p_size\n" + "".join(f"{i},bolt,Brand#1,{i}\n" for i in range(60)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = judge_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), PROMPT, ENDPOINTS[:1], RULES, breaks=False)
        assert done.count() == 120
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [len(list(p.glob("part-*.parquet"))) for p in sorted((tmp_path / "out").glob("file_name=*"))] == [1, 1]
