"""Streaming forms against the bounded ones; one file is one micro-batch."""

import json
import os
import time
from datetime import timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from feeds import READINGS, SF, at, clock, sensor_frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brook.operators import keyed as K
from brook.operators import metrics as M
from brook.operators import multi as C
from brook.operators import scan as S
from brook.plans.oracles import ORACLES
from brook.plans.streams import STREAMS
from brook.sinks import custom, payloads
from brook.sources import replay, text
from brook.sources.views import sensors
from brook.streaming import aggregates as A
from brook.streaming import chunks, late, run, state
from brook.streaming import processors as P
from check import connect, difference

SCHEMA = "event_id bigint, id string, ts timestamp_ntz, vc int, arrival timestamp_ntz"
LATE = [("s1", 1), ("s1", 4), ("s1", 7), ("s1", 3), ("s1", 8), ("s1", 2), ("s1", 9), ("s1", 4), ("s2", 20)]


class Feed:
    """A folder that grows file by file, in a fixed order."""

    def __init__(self, folder):
        self.folder, self.n, self.files = str(folder), 0, 0

    def put(self, *rows):
        """One file with rows (id, event second, level)."""
        ids = list(range(self.n, self.n + len(rows)))
        self.n += len(rows)
        table = pa.table({
            "event_id": pa.array(ids, pa.int64()),
            "id": pa.array([r[0] for r in rows]),
            "ts": pa.array([at(r[1]) for r in rows], pa.timestamp("us")),
            "vc": pa.array([r[2] if len(r) > 2 else 0 for r in rows], pa.int32()),
            "arrival": pa.array([at(i) for i in ids], pa.timestamp("us")),
        })
        path = f"{self.folder}/part-{self.files:05d}.parquet"
        pq.write_table(table, path)
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        return self

    def each(self, rows):
        for r in rows:
            self.put(r)
        return self

    def stream(self, spark):
        schema = T.StructType.fromDDL(SCHEMA)
        return run.event_feed(spark, self.folder, 1, schema)


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    return Feed(folder)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def drained(spark, stream, tmp_path, name="q", idle=True):
    run.drain(stream, f"{tmp_path}/{name}/out", f"{tmp_path}/{name}/checkpoint", idle=idle)
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}/out")


def fired(df):
    return sorted((r.id[-1], r.fire_ms // 1000 - 1549000000) for r in df.collect())


@pytest.mark.parametrize("processor, want", [
    (P.OneTimer(5000), [("1", 44127), ("2", 44130), ("3", 44134)]),
    (P.RisingEvent(5000), [("1", 44127), ("2", 44130)]),
])
def test_event_timers(spark, feed, tmp_path, processor, want):
    rows = feed.each(READINGS).stream(spark).withWatermark("ts", "2 seconds")
    assert fired(drained(spark, P.process(rows, "id", processor), tmp_path)) == want


def test_timer_per_event(spark, feed, tmp_path, readings):
    rows = feed.each(READINGS).stream(spark).withWatermark("ts", "2 seconds")
    got = fired(drained(spark, P.process(rows, "id", P.TimerPerEvent(5000)), tmp_path))
    want = sorted((r.id[-1], clock(r.fire_time)) for r in K.timer_per_event(readings).collect())
    assert got == want


def test_self_cleaning(spark, feed, tmp_path):
    rows = feed.each(READINGS).stream(spark).withWatermark("ts", "2 seconds")
    got = drained(spark, P.process(rows, "id", P.SelfCleaningJump(10, 60_000)), tmp_path).orderBy("event_id")
    assert [(r.id[-1], r.vc, r.diff) for r in got.collect()] == [
        ("2", 40, 40), ("1", 50, 20), ("2", 60, 20), ("1", 70, 20), ("3", 80, 80)]


def test_keyed_values(spark, feed, tmp_path, readings):
    for i in range(0, 11, 4):
        feed.put(*READINGS[i:i + 4])
    got = drained(spark, P.process(feed.stream(spark), "id", P.LastValue()), tmp_path, "last")
    want = K.last_value(readings, "id", "vc").select("event_id", "last")
    assert sorted(map(tuple, got.select("event_id", "last").collect())) == sorted(map(tuple, want.collect()))
    got = drained(spark, P.process(feed.stream(spark), "id", P.JumpAlert(1.7)), tmp_path, "jump")
    assert sorted(r.event_id for r in got.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8]
    rows = feed.stream(spark).withColumn("value", F.col("vc").cast("bigint"))
    got = drained(spark, P.process(rows, "id", P.Reduce(lambda a, b: a * 10 + b)), tmp_path, "reduce")
    assert {r.event_id: r.value for r in got.collect()}[5] == 460


@pytest.mark.parametrize("most", [2, 10_000])
def test_chunked_last_values(spark, feed, tmp_path, readings, most):
    """Batch by batch with keyed state; small Arrow batches cut the rows of a key into several chunks."""
    for i in range(0, 11, 4):
        feed.put(*READINGS[i:i + 4])
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        got = drained(spark, chunks.last_values(feed.stream(spark)), tmp_path, "last").select("event_id", "last")
    finally:
        spark.conf.set(name, before)
    want = K.last_value(readings, "id", "vc").select("event_id", "last")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_chunked_thresholds_and_sums(spark, feed, tmp_path):
    feed.put(("a", 1, 30), ("r", 1, 15)).put(("a", 2, 50), ("a", 3, 52)).put(("r", 4, 0), ("a", 5, 99))
    nothing = F.lit(None).cast("int")
    is_rule = F.col("id") == "r"
    tagged = feed.stream(spark).select(
        "event_id", F.lit("a").alias("id"), F.when(~is_rule, F.col("vc")).otherwise(nothing).alias("vc"),
        F.when(is_rule, F.col("vc")).otherwise(nothing).alias("threshold_vc"), "arrival",
        F.when(is_rule, 0).otherwise(1).alias("rank"))
    got = drained(spark, chunks.threshold_alerts(tagged), tmp_path, "rules").collect()
    assert [(r.event_id, r.vc, r.diff) for r in got] == [(2, 50, 20)]
    values = feed.stream(spark).select("event_id", "id", "arrival", F.col("vc").cast("bigint").alias("value"))
    got = {r.event_id: r.running for r in drained(spark, chunks.running_sums(values), tmp_path, "sums").collect()}
    assert got == {0: 30, 1: 15, 2: 80, 3: 132, 4: 15, 5: 231}


def test_chunks_that_overlap_are_merged():
    carry = chunks.Carry([chunks.Carried("vc")])

    def chunk(*events):
        return {"arrival": list(events), "rank": [0] * len(events), "event_id": list(events), "vc": [10 * e for e in events]}

    assert carry.disjoint([chunk(5, 6), chunk(1, 2), chunk(3)]) == [chunk(1, 2), chunk(3), chunk(5, 6)]
    assert carry.disjoint([chunk(2, 7), chunk(1, 4, 9), chunk(10)]) == [chunk(1, 2, 4, 7, 9), chunk(10)]


def test_late_rows_as_second_output(spark, feed, tmp_path):
    rows = feed.each([(k, s, 0) for k, s in LATE]).stream(spark)
    root = f"{tmp_path}/late"
    run.drain_batches(rows, late.split_writer(root), f"{root}/checkpoint", "append")
    assert [r.event_id for r in spark.read.parquet(f"{root}/late").collect()] == [7]
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/main").collect()) == [0, 1, 2, 3, 4, 5, 6, 8]


def test_refiring_counts(spark, feed, tmp_path):
    """Without the hopelessly late row both lateness rules agree on the final counts."""
    rows = feed.each([(k, s, 0) for i, (k, s) in enumerate(LATE) if i != 7]).stream(spark)
    counts = run.zoneless(A.refiring_count(rows, "id", "5 seconds", "2 seconds", "2 seconds"))
    out = f"{tmp_path}/refire"
    run.drain_batches(counts, run.batch_table(out), f"{tmp_path}/checkpoint")
    final = run.latest_per_key(spark, out, ["id", "window_start"])
    assert {(r.id, int((r.window_start - at(0)).total_seconds()), r.n) for r in final.collect()} == {
        ("s1", 0, 4), ("s1", 5, 3), ("s2", 20, 1)}
    sent = spark.read.parquet(out).where("id = 's1'").groupBy("window_start").count().collect()
    assert sorted(r["count"] for r in sent) == [3, 4]


def test_late_filter_lags_one_batch(spark, feed, tmp_path):
    """A row is judged by the watermark of the batch before: 3 is still taken, 2 is not."""
    rows = feed.each([("s1", s, 0) for s in (1, 4)]).put(("s1", 7)).put(("s1", 3)).put(("s1", 8)).put(
        ("s1", 2)).put(("s1", 20)).stream(spark)
    got = drained(spark, A.tumbling_count(rows, "id", "5 seconds", "2 seconds"), tmp_path)
    first = [r.n for r in got.collect() if r.window_start.replace(tzinfo=timezone.utc).timestamp() == 0]
    assert first == [3]


def test_slowest_input_holds_the_watermark(spark, tmp_path):
    feeds = []
    for name, seconds in (("a", (10, 40)), ("b", (5, 12))):
        (tmp_path / name).mkdir()
        one = Feed(tmp_path / name)
        one.each([(name, s, 0) for s in seconds])
        feeds.append(one.stream(spark).withWatermark("ts", "2 seconds"))
    counts = feeds[0].unionByName(feeds[1]).groupBy("id", F.window("ts", "5 seconds")).count()
    query = run.drain_batches(counts, lambda batch, i: batch.count(), f"{tmp_path}/checkpoint")
    seen = [p["eventTime"].get("watermark", "") for p in query.recentProgress if p.get("eventTime")]
    assert max(seen).startswith("1970-01-01T00:00:10")


def test_expiring_count(spark, feed, tmp_path):
    def go():
        counts = P.partial_counts(feed.stream(spark), "id")
        run.drain_batches(
            P.process(counts, "id", P.TtlCount(4000), "update"), run.batch_table(f"{tmp_path}/out"),
            f"{tmp_path}/checkpoint", idle=False)

    feed.put(("a", 1))
    go()
    time.sleep(6)
    feed.put(("a", 2), ("a", 3))
    go()
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("batch_id").collect()
    assert [r.n for r in got] == [1, 2]


def test_processing_timers_and_rises(spark, feed, tmp_path):
    """Timers of the first run fire in the second, once their time has passed."""
    def go(name, processor):
        return drained(spark, P.process(feed.stream(spark), "id", processor), tmp_path, name, idle=False)

    kinds = {"each": P.ProcessingTimer(2000), "one": P.OneProcessingTimer(2000), "rise": P.RisingProcessing(2000)}
    feed.put(("a", 1, 5), ("a", 2, 6), ("b", 1, 5), ("b", 2, 4))
    for name, processor in kinds.items():
        go(name, processor)
    time.sleep(3)
    feed.put(("c", 9, 9))
    got = {name: sorted(r.id for r in go(name, p).collect()) for name, p in kinds.items()}
    assert got == {"each": ["a", "b"], "one": ["a", "b"], "rise": ["a"]}


def test_gate(spark, feed, tmp_path):
    def go():
        rows = feed.stream(spark).select(
            "event_id", "id", "vc", "arrival", F.lit(0).alias("rank"),
            F.when(F.col("vc") < 0, F.lit(3000).cast("bigint")).alias("duration_ms"))
        return drained(spark, P.process(rows, "id", P.Gate()), tmp_path, idle=False)

    feed.put(("a", 1, 1)).put(("a", 2, -1)).put(("a", 3, 3), ("b", 3, 9))
    assert [(r.id, r.vc) for r in go().collect()] == [("a", 3)]
    time.sleep(4)
    feed.put(("a", 9, 4))
    assert [(r.id, r.vc) for r in go().collect()] == [("a", 3)]


def test_buffer_survives_restart(spark, feed, tmp_path):
    def go():
        rows = feed.stream(spark).withColumn("shard", F.lit(0))
        return drained(spark, P.process(rows, "shard", P.Buffer(3)), tmp_path)

    feed.put(("a", 1, 1), ("a", 2, 2))
    assert go().count() == 0
    feed.put(("a", 3, 3), ("a", 4, 4))
    assert sorted(r.event_id for r in go().collect()) == [0, 1, 2]


def test_state_is_readable_and_survives_restart(spark, feed, tmp_path):
    def go():
        counts = P.partial_counts(feed.stream(spark), "id")
        run.drain_batches(
            P.process(counts, "id", P.RunningCount(), "update"), run.batch_table(f"{tmp_path}/out"),
            f"{tmp_path}/checkpoint")
        return {k: state.lookup(spark, f"{tmp_path}/checkpoint", "count", k).collect()[0].value.n for k in "ab"}

    feed.put(("a", 1), ("a", 2), ("b", 1))
    assert go() == {"a": 2, "b": 1}
    feed.put(("b", 5))
    assert go() == {"a": 2, "b": 2}


def test_session_stays_open_at_the_end(spark, feed, tmp_path):
    rows = feed.each([("a", 0, 0), ("a", 5, 0), ("a", 11, 0), ("a", 40, 0)]).stream(spark)
    got = drained(spark, A.session_count(rows, "id", "5 seconds", "2 seconds"), tmp_path)
    assert sorted(r.n for r in got.collect()) == [1, 2]


def test_unique_visitors(spark, feed, tmp_path):
    feed.put(("a", 1), ("b", 1)).put(("a", 2), ("c", 2))
    run.drain_batches(
        A.unique_visitors(feed.stream(spark), "id"), run.batch_table(f"{tmp_path}/uv"), f"{tmp_path}/cp", "complete")
    got = spark.read.parquet(f"{tmp_path}/uv").groupBy("batch_id").agg(F.max("uv").alias("uv")).collect()
    assert max(r.uv for r in got) == 3


def test_metrics_in_progress(spark, feed, tmp_path):
    rows = feed.each([("a", 10, 1), ("a", 20, 2)]).stream(spark).withWatermark("ts", "2 seconds")
    watched = M.observed(rows, MapCounter=F.count(F.lit(1)), weighted=F.sum(F.lit(2)))
    counts = watched.groupBy("id", F.window("ts", "5 seconds")).count()
    query = run.drain_batches(counts, lambda batch, i: batch.count(), f"{tmp_path}/cp")
    seen = [p["observedMetrics"]["MyGroup"] for p in query.recentProgress if "MyGroup" in p["observedMetrics"]]
    assert run.watermark_gauge(query).startswith("1970-01-01T00:00:18")
    assert run.latest_metric(query, "MyGroup", "MapCounter") is not None
    assert sum(m["MapCounter"] for m in seen) == 2 and sum(m["weighted"] or 0 for m in seen) == 4
    assert any(p["eventTime"].get("watermark", "").startswith("1970-01-01T00:00:18") for p in query.recentProgress)
    assert all("durationMs" in p for p in query.recentProgress)


def test_replay_continues_after_restart(spark, tmp_path):
    spark.dataSource.register(replay.ReplaySource)
    (tmp_path / "feed").mkdir()
    grown = Feed(tmp_path / "feed")
    schema = T.StructType.fromDDL(SCHEMA)

    def go():
        stream = spark.readStream.format("brook_replay").schema(schema).option("path", grown.folder).load()
        return sorted(r.event_id for r in drained(spark, stream, tmp_path).collect())

    grown.each([("a", s, s) for s in range(5)])
    assert go() == list(range(5))
    assert go() == list(range(5))
    grown.each([("b", s, s) for s in range(2)])
    assert go() == list(range(7))


def test_lines_from_sockets_and_queues(spark):
    """The external feeds: shape and options; no connection is made."""
    assert text.queue_options("host:9092", "topic", "group") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "topic", "kafka.group.id": "group",
        "startingOffsets": "latest"}
    lines = text.socket_lines(spark, "localhost", 9999)
    assert lines.isStreaming and lines.columns == ["line"]


def test_side_output(spark, feed, tmp_path):
    rows = feed.put(("a", 1, 99), ("b", 1, 101)).put(("c", 2, 300)).stream(spark)
    root = f"{tmp_path}/alarm"
    write = run.two_outputs(root, lambda df: C.side_output(df, F.col("vc") > 100, F.concat("id", F.lit("!"))))
    run.drain_batches(rows, write, f"{root}/checkpoint", "append")
    assert spark.read.parquet(f"{root}/main").count() == 3
    assert sorted(r.alarm for r in spark.read.parquet(f"{root}/side").collect()) == ["b!", "c!"]


def test_upsert_sinks(spark, feed, tmp_path):
    """Documents per user: a later batch overwrites, one write per user and batch."""
    store = tmp_path / "store"
    store.mkdir()

    def send(rows):  # stands for a client that puts one document per id
        for row in rows:
            (store / row.doc_id).write_text(row.source)

    rows = feed.put(("u", 1, 1), ("u", 2, 1), ("u", 1, 2)).put(("u", 7, 1)).stream(spark)
    behaviors = rows.select(
        F.col("vc").cast("bigint").alias("user_id"), F.col("event_id").alias("item_id"), F.lit("pv").alias("behavior"), "ts")
    run.drain_batches(behaviors, payloads.upsert_writer(send, payloads.documents), f"{tmp_path}/cp", "append")
    got = {p.name: json.loads(p.read_text())["itemId"] for p in store.iterdir()}
    assert got == {"1": "3", "2": "2"}


def test_custom_sink_counts_only_committed_files(spark, feed, tmp_path):
    spark.dataSource.register(custom.RowsSink)
    rows = feed.put(("u", 1, 1)).put(("u", 2, 2)).stream(spark).select(
        F.col("vc").alias("user_id"), F.col("event_id").cast("string").alias("item_id"), F.lit("pv").alias("behavior"))
    out = f"{tmp_path}/sink"
    query = rows.writeStream.format("brook_rows").option("path", out).option(
        "checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    with open(f"{out}/data/stray.jsonl", "w") as stray:  # left by a lost task
        stray.write('{"user_id": 9, "item_id": "9", "behavior": "pv"}\n')
    assert sorted(r.user_id for r in custom.read_committed(spark, out).collect()) == [1, 2]


def test_console(spark, feed, tmp_path, capfd):
    query = run.console(feed.put(("a", 1, 7)).stream(spark).select("id", "vc"), "label", f"{tmp_path}/cp")
    query.processAllAvailable()
    query.stop()
    assert query.name == "label"


@pytest.mark.parametrize("layout", ["one file", "many in order", "many shuffled"])
def test_registered_streams_for_any_layout(spark, tmp_path, layout):
    """The same answers however the table is cut into files, over five micro-batches at least."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    if layout != "one file":
        order = ["ts", "event_id"] if layout == "many in order" else [F.xxhash64("event_id")]
        events.repartitionByRange(40, *order).write.parquet(f"{tmp_path}/events.parquet")
    else:
        events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = connect(SF)
    for name in ("stream_jump_alert", "stream_session_count", "stream_timer_per_event"):
        assert difference(STREAMS[name](spark, str(tmp_path)), con.execute(ORACLES[name]).df()) == "", name
    feed = run.ordered_feed(sensors(spark, str(tmp_path)), ("arrival", "event_id"), f"{tmp_path}/feed")
    query = run.drain(feed, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= 5
    assert spark.read.parquet(f"{tmp_path}/out").count() == events.count()


def test_running_counts_reach_a_key_value_store(spark, feed, tmp_path):
    feed.each([("a", 1, 0), ("b", 2, 0), ("a", 3, 0), ("a", 4, 0)])
    counts = payloads.kv_running(A.running_count(feed.stream(spark), "id"), "id")
    run.drain_batches(counts, run.batch_table(f"{tmp_path}/kv"), f"{tmp_path}/checkpoint")
    last = run.latest_per_key(spark, f"{tmp_path}/kv", ["key"])
    assert sorted(map(tuple, last.collect())) == [("a", "3"), ("b", "1")]
