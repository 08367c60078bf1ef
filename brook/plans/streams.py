"""Registered streaming queries: run to the end of the stored feed, then read back.

Results go to tables in the shared folder, never through the driver. A query
that closes windows by watermark answers for the windows closed by the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook import schemas, session
from brook.functions.durations import from_micros
from brook.operators import scan as S_
from brook.operators.rolling import tokenize
from brook.plans.queries import written_lines
from brook.sinks import custom, payloads
from brook.sources import replay, text
from brook.sources import views as V
from brook.streaming import aggregates as A
from brook.streaming import processors as S
from brook.streaming import chunks, late, run, state


def _places(spark: SparkSession, name: str) -> tuple[str, str]:
    root = session.shared_dir(spark, name)
    return f"{root}/out", f"{root}/checkpoint"


def _stateful(spark: SparkSession) -> None:
    """Keyed processors need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", session.ROCKSDB)


#: Arrivals are up to six hours behind their event time, so with this bound no row is late.
DISORDER = "6 hours"


#: Ordered feeds of this session, by application and folder of the tables: streams over one table share one copy.
_feeds: dict[tuple[str, str], str] = {}


def _sensor_feed(spark, sf_dir) -> DataFrame:
    """Sensor rows in order of arrival, over several micro-batches."""
    rows = V.as_sensors(V.events(spark, sf_dir))
    which = (spark.sparkContext.applicationId, sf_dir)
    if which not in _feeds:
        path = f"{session.shared_dir(spark, 'feed')}/rows"
        run.ordered_files(rows, ("arrival", "event_id"), path)
        _feeds[which] = path
    return run.event_feed(spark, _feeds[which], run.FILES_PER_BATCH, rows.schema)


def _appended(spark, stream: DataFrame, name: str) -> DataFrame:
    out, checkpoint = _places(spark, name)
    run.drain(stream, out, checkpoint)
    return run.zoneless(spark.read.schema(stream.schema).parquet(out))


def _updated(spark, stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    out, checkpoint = _places(spark, name)
    run.drain_batches(stream, run.batch_table(out), checkpoint)
    return run.latest_per_key(spark, out, keys)


def src_file_stream(spark, sf_dir):
    return _appended(spark, text.stream_lines(spark, written_lines(spark, sf_dir)), "file-stream")


def src_replay(spark, sf_dir):
    spark.dataSource.register(replay.ReplaySource)
    feed = (
        spark.readStream.format("brook_replay").schema(schemas.EVENTS)
        .option("path", f"{sf_dir}/events.parquet").load()
    )
    return _appended(spark, feed, "replay")


def stream_word_count(spark, sf_dir):
    lines = text.stream_lines(spark, written_lines(spark, sf_dir))
    return _updated(spark, A.word_count(lines), "stream-words", ["word"])


def restartable_word_count(spark, sf_dir):
    """Stopped after the first part of the feed, started again for the rest."""
    root = session.shared_dir(spark, "restart")
    lines = V.table(spark, sf_dir, "documents").select("lang", F.col("text").alias("line"))
    for english in (True, False):
        part = lines.where(F.col("lang").eqNullSafe("en") == english).select("line")
        part.write.mode("append").option("lineSep", "\n").text(f"{root}/lines")
        counts = A.word_count(text.stream_lines(spark, f"{root}/lines"))
        run.drain_batches(counts, run.batch_table(f"{root}/out"), f"{root}/checkpoint")
    return run.latest_per_key(spark, f"{root}/out", ["word"])


def stream_tumbling_count(spark, sf_dir):
    feed = _sensor_feed(spark, sf_dir)
    return _appended(spark, A.tumbling_count(feed, "id", "5 hours", DISORDER), "stream-tumbling")


def stream_sliding_count(spark, sf_dir):
    feed = _sensor_feed(spark, sf_dir).where(F.col("event_type") == V.PAGE_VIEW)
    return _appended(spark, A.tumbling_count(feed, "id", "50 hours", DISORDER, "5 hours"), "stream-sliding")


def stream_session_count(spark, sf_dir):
    feed = _sensor_feed(spark, sf_dir).where(F.col("event_type") == V.PAGE_VIEW)
    with run.local_sessions(spark):
        return _appended(spark, A.session_count(feed, "id", "5 hours", DISORDER), "stream-session")


def stream_uv(spark, sf_dir):
    out, checkpoint = _places(spark, "stream-uv")
    views = run.event_feed(spark, f"{sf_dir}/events.parquet").where(F.col("event_type") == V.PAGE_VIEW)
    run.drain_batches(A.unique_visitors(views), run.batch_table(out), checkpoint, "complete")
    last = spark.read.parquet(out)
    return last.agg(F.max_by("uv", "batch_id").alias("uv"))


def stateful_count(spark, sf_dir):
    _stateful(spark)
    words = tokenize(text.stream_lines(spark, written_lines(spark, sf_dir)))
    return _updated(spark, S.bucket_counts(S.partial_counts(words, "word"), "word"), "stateful", ["key"])


def state_lookup(spark, sf_dir):
    """The keyed state of a finished run, read from its checkpoint by state name."""
    _stateful(spark)
    out, checkpoint = _places(spark, "lookup")
    feed = S.partial_counts(_sensor_feed(spark, sf_dir), "id")
    run.drain_batches(S.bucket_counts(feed, "id", 256), run.batch_table(out), checkpoint)
    held = state.read_state(spark, checkpoint, "counts")
    return held.select(F.explode(F.arrays_zip("value.key", "value.n")).alias("c")).select(
        F.col("c.key").alias("id"), F.col("c.n").alias("n"))


def _tagged_feed(spark, sf_dir) -> DataFrame:
    """Rules (rank 0) and readings (rank 1) as one stream: a sign-up is both."""
    nothing = F.lit(None).cast("int")
    rule = F.when(F.col("event_type") == "signup", F.struct(
        nothing.alias("vc"), F.lit(0).alias("rank"), (F.col("vc") % 40).alias("threshold_vc")))
    reading = F.struct("vc", F.lit(1).alias("rank"), nothing.alias("threshold_vc"))
    both = _sensor_feed(spark, sf_dir).select("event_id", "id", "arrival", F.explode(F.array(rule, reading)).alias("r"))
    return both.where("r is not null").select("event_id", "id", "r.vc", "arrival", "r.rank", "r.threshold_vc")


def stream_dynamic_threshold(spark, sf_dir):
    _stateful(spark)
    return _appended(spark, chunks.threshold_alerts(_tagged_feed(spark, sf_dir)), "stream-rules")


def stream_jump_alert(spark, sf_dir):
    _stateful(spark)
    return _appended(spark, chunks.jump_alerts(_sensor_feed(spark, sf_dir), 1.7), "stream-jump").withColumn(
        "diff", F.col("diff").cast("int"))


def stream_last_value(spark, sf_dir):
    _stateful(spark)
    return _appended(spark, chunks.last_values(_sensor_feed(spark, sf_dir)), "stream-last")


def stream_rolling_sum(spark, sf_dir):
    _stateful(spark)
    feed = _sensor_feed(spark, sf_dir).select(
        "event_id", F.col("event_type").alias("id"), "arrival", F.lit(1).cast("bigint").alias("value"))
    return _appended(spark, chunks.running_sums(feed), "stream-sum")


def _in_parts(spark, sf_dir, name: str, parts: int, drain) -> str:
    """The feed in order of arrival cut into equal parts; ``drain`` runs a query over what is there after each of them."""
    root = session.shared_dir(spark, name)
    rows = V.sensors(spark, sf_dir).select("event_id", "id", "ts", "vc", "arrival")
    placed = S_.scan(rows, [], ("arrival", "event_id")).add(_pos=S_.position())
    part = F.expr(f"(_pos - 1) * {parts}L div {placed.n_rows}L")
    placed.rows().withColumn("part", part).drop("_pos").write.partitionBy("part").parquet(f"{root}/parts")
    for i in range(parts):  # a part's files are there before the run that takes them, so order needs no file times
        spark.read.schema(rows.schema).parquet(f"{root}/parts/part={i}").write.parquet(f"{root}/feed/{i}")
        drain(run.event_feed(spark, f"{root}/feed/*", 1_000_000, rows.schema), root)
    return root


def stream_late_refire(spark, sf_dir):
    """Window counts that fire again with rows up to two hours too late, over five micro-batches."""
    _stateful(spark)
    hour = 3_600_000
    buckets = max(256, V.events(spark, sf_dir).count() // 100_000)  # a bucket's windows stay bounded

    def drain(feed, root):
        counts = S.window_counts(feed.withWatermark("ts", "2 hours"), "5 hours")
        fired = S.late_windows(counts, 5 * hour, 2 * hour, buckets)
        run.drain(fired, f"{root}/out", f"{root}/checkpoint")

    out = spark.read.parquet(f"{_in_parts(spark, sf_dir, 'late-refire', 5, drain)}/out")
    start = F.col("start_ms") * 1000
    return out.select("id", from_micros(start).alias("window_start"), from_micros(start + 5 * hour * 1000).alias("window_end"),
                      "firing", "n")


def stream_late_side_output(spark, sf_dir):
    """Rows too late even for the allowed lateness, over five micro-batches."""
    def drain(feed, root):
        write = late.split_writer(root, "5 hours", "2 hours", "2 hours")
        run.drain_batches(feed, write, f"{root}/checkpoint", "append")

    root = _in_parts(spark, sf_dir, "late-rows", 5, drain)
    return run.zoneless(spark.read.parquet(f"{root}/late")).drop("batch_id")


def stateful_threshold(spark, sf_dir):
    """The dynamic-threshold alert with its state in a keyed processor."""
    _stateful(spark)
    return _appended(
        spark, S.process(_tagged_feed(spark, sf_dir), "id", S.DynamicThreshold()), "stateful-rules")


def stream_timer_per_event(spark, sf_dir):
    """Timers fired by the end of the feed."""
    _stateful(spark)
    feed = S.distinct_per_batch(_sensor_feed(spark, sf_dir), "id", "ts").withWatermark("ts", DISORDER)
    fired = _appended(spark, S.process(feed, "id", S.TimerPerEvent(5 * 3_600_000)), "stream-timers")
    return fired.select("id", from_micros(F.col("fire_ms") * 1000).alias("fire_time"))


def _event_timers(spark, sf_dir, name: str, processor: type, *options) -> DataFrame:
    """A processor on event-time timers over five micro-batches, each judged by the watermark of those before it."""
    _stateful(spark)

    def drain(feed, root):
        rows = feed.withWatermark("ts", "2 hours")
        # Times without the watermark's mark: else the engine would drop late rows before they reach the processor.
        rows = rows.withColumn("ts", F.col("ts") + F.expr("INTERVAL 0 SECOND"))
        run.drain(S.process(rows, "id", processor(*options)), f"{root}/out", f"{root}/checkpoint")

    return spark.read.parquet(f"{_in_parts(spark, sf_dir, name, 5, drain)}/out")


def _fire_times(rows: DataFrame) -> DataFrame:
    return rows.select("id", from_micros(F.col("fire_ms") * 1000).alias("fire_time"))


def stream_timer_one_per_key(spark, sf_dir):
    return _fire_times(_event_timers(spark, sf_dir, "one-timer", S.OneTimer, 5 * 3_600_000))


def stream_rising_alert(spark, sf_dir):
    return _fire_times(_event_timers(spark, sf_dir, "rising", S.RisingEvent, 5 * 3_600_000))


def stream_jump_self_cleaning(spark, sf_dir):
    return _event_timers(spark, sf_dir, "self-cleaning", S.SelfCleaningJump, 10, 60 * 3_600_000)


def _shards(rows: DataFrame) -> DataFrame:
    return rows.withColumn("shard", F.pmod("event_id", F.lit(16)).cast("int"))


def buffer_restart(spark, sf_dir):
    """A buffer of three per shard, stopped half-way through the feed and started again from its checkpoint."""
    _stateful(spark)
    root = session.shared_dir(spark, "buffer-restart")
    rows = _shards(V.sensors(spark, sf_dir))
    clock = F.col("arrival").cast("timestamp").cast("double")
    half = rows.agg(((F.min(clock) + F.max(clock)) / 2).alias("half")).first().half
    for place, part in enumerate((clock <= half, clock > half)):
        run.ordered_files(rows.where(part), ("arrival", "event_id"), f"{root}/feed/{place}")
        feed = run.event_feed(spark, f"{root}/feed/*", run.FILES_PER_BATCH, rows.schema)
        run.drain(S.process(feed, "shard", S.Buffer(3)), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


def state_lookup_list(spark, sf_dir):
    """The rows that a buffer of three per shard still holds when its query has stopped, from its list state."""
    _stateful(spark)
    out, checkpoint = _places(spark, "lookup-list")
    run.drain(S.process(_shards(_sensor_feed(spark, sf_dir)), "shard", S.Buffer(3)), out, checkpoint)
    held = state.read_list(spark, checkpoint, "held")
    return held.select(F.col("key.shard").alias("shard"), F.col("value.event_id").alias("event_id"), F.col("value.vc").alias("vc"))


def stream_kv_upsert(spark, sf_dir):
    """The running page views of each user, as a key-value store holds them at the end of the feed."""
    views = _sensor_feed(spark, sf_dir).where(F.col("event_type") == V.PAGE_VIEW)
    counts = payloads.kv_running(A.running_count(views, "id"), "id")
    return _updated(spark, counts, "stream-kv", ["key"])


def _observed(spark, sf_dir, name: str):
    """A finished run that shows the last reading as a metric and keeps a watermark."""
    out, checkpoint = _places(spark, name)
    last = F.max_by("vc", F.struct("arrival", "event_id")).alias("last_vc")
    feed = _sensor_feed(spark, sf_dir).observe("readings", last)
    return run.drain(A.tumbling_count(feed, "id", "5 hours", DISORDER), out, checkpoint)


def metric_gauge(spark, sf_dir):
    """What a gauge on the last reading shows when the feed has ended."""
    value = run.latest_metric(_observed(spark, sf_dir, "gauge"), "readings", "last_vc")
    return spark.createDataFrame([(value,)], "last_vc int")


def metric_watermark(spark, sf_dir):
    """What a gauge on the watermark shows when the feed has ended."""
    mark = run.watermark_gauge(_observed(spark, sf_dir, "watermark"))
    return spark.createDataFrame([(mark,)], "at string").select(
        F.to_timestamp("at").cast("timestamp_ntz").alias("watermark"))


def sink_custom(spark, sf_dir):
    """A stream written through the custom sink, and what it committed."""
    spark.dataSource.register(custom.RowsSink)
    out, checkpoint = _places(spark, "custom-sink")
    rows = payloads.jdbc_rows(V.as_behaviors(run.event_feed(spark, f"{sf_dir}/events.parquet")))
    query = (
        rows.writeStream.format("brook_rows").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return custom.read_committed(spark, out)


STREAMS = {
    f.__name__: f
    for f in (
        src_file_stream, src_replay, stream_word_count, restartable_word_count,
        stream_tumbling_count, stream_sliding_count, stream_session_count, stream_uv,
        stateful_count, state_lookup, stream_dynamic_threshold, stateful_threshold,
        stream_jump_alert, stream_last_value, stream_rolling_sum,
        stream_late_refire, stream_late_side_output, state_lookup_list, stream_timer_one_per_key, stream_rising_alert,
        stream_jump_self_cleaning,
        stream_timer_per_event, buffer_restart, stream_kv_upsert, metric_gauge, metric_watermark, sink_custom,
    )
}
