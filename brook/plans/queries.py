"""One function per registered query: (spark, folder of the tables) -> DataFrame.

The stored events are about seven hours apart per user, so the queries read one
second of the operators' defaults as one hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook import session
from brook.functions import text as X
from brook.functions.durations import from_seconds
from brook.operators import eventtime as E
from brook.operators import keyed as K
from brook.operators import metrics as M
from brook.operators import multi as C
from brook.operators import rolling as R
from brook.operators import windows as W
from brook.operators.rowwise import map_with_lifecycle as map_rows_with_lifecycle
from brook.sinks import payloads as P
from brook.sources import parse, text
from brook.sources import views as V

BY_TS = ("ts", "item_id")
ARRIVAL = ("arrival", "event_id")


# -- sources -------------------------------------------------------------------

def written_lines(spark: SparkSession, sf_dir: str) -> str:
    """The documents as text files, the way a line feed would deliver them."""
    path = session.shared_dir(spark, "lines")
    V.lines(spark, sf_dir).select("line").write.option("lineSep", "\n").text(path)
    return path


def src_text_lines(spark, sf_dir):
    return text.read_lines(spark, written_lines(spark, sf_dir))


def src_collection(spark, sf_dir):
    # The two gate switches of the in-memory collection.
    pairs = text.collection(
        spark, [("sensor_1", 10_000), ("sensor_2", 60_000)], "id string, duration_ms bigint")
    return V.sensors(spark, sf_dir).join(F.broadcast(pairs), "id").groupBy("id", "duration_ms").agg(
        F.count("*").alias("n"))


def _behavior_lines(spark, sf_dir) -> DataFrame:
    """Events as CSV lines; the clock of an error event is not a whole number."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    clock = F.when(F.col("event_type") == "error", F.concat(F.lit("~"), seconds)).otherwise(seconds)
    k = F.get_json_object("props", "$.k")
    return V.events(spark, sf_dir).select(
        F.concat_ws(",", "user_id", "event_id", k, "event_type", clock).alias("line"))


def parse_behavior_csv(spark, sf_dir):
    return parse.behavior_csv(_behavior_lines(spark, sf_dir))[0]


def parse_behavior_bad(spark, sf_dir):
    return parse.behavior_csv(_behavior_lines(spark, sf_dir))[1]


def parse_sensor_csv(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    lines = V.sensors(spark, sf_dir).select(
        F.concat_ws(",", "id", seconds, F.col("vc").cast("string")).alias("line"))
    return parse.sensor_csv(lines)[0]


def parse_threshold_json(spark, sf_dir):
    """Rules from the events; error events give broken JSON, views give ``null``."""
    rule = F.concat(
        F.lit('{"id": "sensor_'), F.col("user_id").cast("string"), F.lit('", "thresholdVc": '),
        F.floor("value").cast("string"), F.lit("}"))
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), rule))
        .when(F.col("event_type") == "view", "null").otherwise(rule))
    return parse.threshold_json(V.events(spark, sf_dir).select(line.alias("line")))


# -- projections, filters, row functions ---------------------------------------

def map_project(spark, sf_dir):
    return V.page_views(spark, sf_dir).select(
        F.lit("pv").alias("key"), F.lit(1).cast("bigint").alias("one"), "item_id")


def map_with_lifecycle(spark, sf_dir):
    """Records as text; the template stands for something costly to set up."""
    def apply(template, pdf):
        made = template[0]
        for column, rest in zip((pdf.user_id, pdf.item_id, pdf.behavior), template[1:], strict=True):
            made = made + column.astype(str) + rest
        return pdf[["item_id"]].assign(text=made)

    return map_rows_with_lifecycle(
        V.behaviors(spark, sf_dir).select("user_id", "item_id", "behavior"),
        lambda: ("user=", " item=", " behavior=", ""), apply, lambda template: None,
        "item_id bigint, text string")


def filter_pv(spark, sf_dir):
    return V.page_views(spark, sf_dir)


def flatmap_tokenize(spark, sf_dir):
    return R.tokenize(V.lines(spark, sf_dir), keep=["doc_id"])


def key_partition_stats(spark, sf_dir):
    return R.count_by(V.sensors(spark, sf_dir), "id")


def format_window_text(spark, sf_dir):
    rows = W.tumbling_count(V.behaviors(spark, sf_dir), "behavior", "ts", "10 hours")
    return rows.select(X.window_text("behavior", "window_start", "window_end", "n").alias("text"))


def epoch_convert(spark, sf_dir):
    """Seconds as read from a file, as milliseconds, and back as a timestamp."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return V.events(spark, sf_dir).select(
        "event_id", seconds.alias("epoch_s"), (seconds * 1000).alias("epoch_ms"),
        from_seconds(seconds).alias("ts"))


def process_element(spark, sf_dir):
    return K.process_element(V.sensors(spark, sf_dir), "id", "ts")


# -- several inputs ------------------------------------------------------------

def union_streams(spark, sf_dir):
    rows = V.behaviors(spark, sf_dir)
    kinds = [rows.where(F.col("behavior") == k) for k in ("view", "click", "view")]
    return C.union_all(*kinds)


def connect_comap(spark, sf_dir):
    return C.connect(
        V.behaviors(spark, sf_dir), V.sensors(spark, sf_dir),
        F.col("behavior"), F.concat(F.col("id"), F.lit(":"), F.col("vc").cast("string")))


def gate_forward(spark, sf_dir):
    return C.gate_forward(V.sensors(spark, sf_dir), V.switches(spark, sf_dir))


def gate_forward_extend(spark, sf_dir):
    return C.gate_forward(V.sensors(spark, sf_dir), V.switches(spark, sf_dir), extend=True)


def dynamic_threshold_alert(spark, sf_dir):
    return C.dynamic_threshold_alert(V.sensors(spark, sf_dir), V.rules(spark, sf_dir))


def _side_output(spark, sf_dir):
    alarm = F.concat(F.col("id"), F.lit(" level "), F.col("vc").cast("string"), F.lit(" is over 100"))
    return C.side_output(V.sensors(spark, sf_dir), F.col("vc") > 100, alarm)


def side_output_main(spark, sf_dir):
    return _side_output(spark, sf_dir)[0]


def side_output_alarm(spark, sf_dir):
    return _side_output(spark, sf_dir)[1]


# -- aggregates without windows ------------------------------------------------

def word_count(spark, sf_dir):
    return R.word_count(V.lines(spark, sf_dir))


def rolling_sum(spark, sf_dir):
    rows = V.behaviors(spark, sf_dir).select("behavior", "ts", "item_id").withColumn("one", F.lit(1).cast("bigint"))
    return R.rolling_sum(rows, ["behavior"], BY_TS, "one")


def rolling_reduce(spark, sf_dir):
    rows = V.sensors(spark, sf_dir).select("event_id", "id", "arrival", F.col("vc").cast("bigint").alias("vc"))
    return R.rolling_reduce(rows, ["id"], ARRIVAL, "vc")


def rolling_reduce_general(spark, sf_dir):
    """A combiner that does not commute and whose values grow: the levels of a sensor so far, in order."""
    rows = V.sensors(spark, sf_dir).select("event_id", "id", "arrival", F.col("vc").cast("string").alias("levels"))
    return R.rolling_fold(rows, ["id"], ARRIVAL, "levels", lambda a, b: f"{a},{b}").select("event_id", "id", "running")


def _extreme(kind: str, whole: bool):
    def query(spark, sf_dir):
        rows = V.sensors(spark, sf_dir).select("event_id", "id", "arrival", "ts", "vc")
        field = "ts" if kind == "min" else "vc"
        record = ["event_id", "ts", "vc"] if whole else []
        return R.rolling_extreme(rows, ["id"], ARRIVAL, field, kind, record)

    return query


def pv_total(spark, sf_dir):
    return V.page_views(spark, sf_dir).agg(F.count("*").alias("pv"))


def pv_total_running(spark, sf_dir):
    return R.running_total(V.page_views(spark, sf_dir).select("ts", "item_id"), BY_TS, "pv")


def uv_total(spark, sf_dir):
    return V.page_views(spark, sf_dir).select("user_id").distinct().agg(F.count("*").alias("uv"))


def uv_running(spark, sf_dir):
    rows = V.page_views(spark, sf_dir).select("ts", "item_id", "user_id")
    return R.running_distinct(rows, "user_id", BY_TS, "uv")


def uv_approx(spark, sf_dir):
    return R.approximate_distinct(V.page_views(spark, sf_dir), "user_id")


def uv_bitmap(spark, sf_dir):
    """Exact unique visitors per window, and of all windows together (null) from the same bitmaps."""
    start = F.window("ts", "10 hours")["start"].alias("window_start")
    panes = R.bitmap_members(V.page_views(spark, sf_dir), "user_id", [start])
    total = R.count_bitmaps(R.merge_bitmaps(panes))
    return R.count_bitmaps(panes, "window_start").unionByName(
        total.select(F.lit(None).cast("timestamp_ntz").alias("window_start"), "uv"))


def channel_behavior_count(spark, sf_dir):
    key = F.concat_ws("_", "channel", "behavior")
    return V.marketing(spark, sf_dir).groupBy(key.alias("channel_behavior")).agg(F.count("*").alias("n"))


def channel_behavior_running(spark, sf_dir):
    key = F.concat_ws("_", "channel", "behavior")
    rows = V.marketing(spark, sf_dir).select(key.alias("channel_behavior"), "ts", "event_id")
    return R.rolling_count(rows, ["channel_behavior"], ("ts", "event_id"), "n")


def pv_per_user(spark, sf_dir):
    rows = V.page_views(spark, sf_dir).select("user_id", "ts", "item_id")
    return R.rolling_count(rows, ["user_id"], BY_TS, "n")


def count_average(spark, sf_dir):
    return R.count_average(V.sensors(spark, sf_dir), "id", ARRIVAL, "vc", 2)


def buffer_release(spark, sf_dir):
    return R.buffer_release(V.sensors(spark, sf_dir), ARRIVAL, 3)


# -- windows -------------------------------------------------------------------

def tumbling_count(spark, sf_dir):
    return W.tumbling_count(V.sensors(spark, sf_dir), "id", "ts", "5 hours")


def sliding_count(spark, sf_dir):
    return W.sliding_count(V.page_views(spark, sf_dir), "user_id", "ts", "50 hours", "5 hours")


def session_count(spark, sf_dir):
    return W.session_count(V.page_views(spark, sf_dir), "user_id", BY_TS, "5 hours")


def count_window_tumbling(spark, sf_dir):
    return W.count_window(V.page_views(spark, sf_dir), "user_id", BY_TS, 5)


def count_window_sliding(spark, sf_dir):
    return W.count_window(V.page_views(spark, sf_dir), "user_id", BY_TS, 5, 2)


def window_reduce_sum(spark, sf_dir):
    rows = V.behaviors(spark, sf_dir).withColumn("one", F.lit(1).cast("bigint"))
    return W.windowed(rows, ["behavior"], "ts", "10 hours", [F.sum("one").alias("n")])


def window_aggregate_count(spark, sf_dir):
    """Counts only, without the key they belong to."""
    return W.tumbling_count(V.behaviors(spark, sf_dir), "behavior", "ts", "10 hours").select("window_start", "n")


def window_avg(spark, sf_dir):
    return W.window_average(V.sensors(spark, sf_dir), "id", "vc", "ts", "15 hours")


#: The four methods of a user's aggregate: sum, count, least and greatest level.
LEVELS = {
    "zero": lambda: (0, 0, None, None),
    "add": lambda a, row: (a[0] + row.vc, a[1] + 1, row.vc if a[2] is None else min(a[2], row.vc),
                           row.vc if a[3] is None else max(a[3], row.vc)),
    "merge": lambda a, b: (a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3])),
    "result": lambda a: (int(a[1]), a[0] / a[1], int(a[3] - a[2])),
    "accumulator": "s bigint, c bigint, lo bigint, hi bigint",
    "output": "n bigint, mean double, spread bigint",
}


def window_user_aggregate(spark, sf_dir):
    return W.user_aggregate(V.sensors(spark, sf_dir).select("id", "ts", "vc"), ["id"], "ts", "15 hours", **LEVELS)


def session_user_aggregate(spark, sf_dir):
    return W.session_aggregate(V.sensors(spark, sf_dir).select("id", "ts", "vc"), "id", "ts", "5 hours", **LEVELS)


def window_minmax(spark, sf_dir):
    return W.window_minmax(V.sensors(spark, sf_dir), "id", "vc", "ts", "10 hours")


def window_minmax_incremental(spark, sf_dir):
    """Reduce to one element per window first, then attach key and bounds as text."""
    rows = W.window_minmax(V.sensors(spark, sf_dir), "id", "vc", "ts", "10 hours")
    return rows.select("id", "min", "max", X.stamp("window_start").alias("start_text"), X.stamp("window_end").alias("end_text"))


def window_count_text(spark, sf_dir):
    rows = W.windowed(
        V.page_views(spark, sf_dir).withColumn("one", F.lit(1).cast("bigint")),
        ["user_id"], "ts", "10 hours", [F.sum("one").alias("n")])
    return rows.select(X.window_text("user_id", "window_start", "window_end", "n").alias("text"))


# -- event time ----------------------------------------------------------------

def watermark_ascending(spark, sf_dir):
    rows = V.sensors(spark, sf_dir).select("event_id", "ts")
    return E.watermark_per_record(rows, ("ts", "event_id"), bound="1 millisecond")


def watermark_bounded(spark, sf_dir):
    rows = V.sensors(spark, sf_dir).select("event_id", "ts")
    return E.watermark_per_record(rows, ("ts", "event_id"), bound="2 hours")


def watermark_per_record(spark, sf_dir):
    rows = V.sensors(spark, sf_dir).select("event_id", "ts", "arrival")
    return E.watermark_per_record(rows, ARRIVAL, bound="2 hours")


def watermark_per_batch(spark, sf_dir):
    return E.watermark_per_block(V.sensors(spark, sf_dir), "arrival", "ts", "10 hours", "2 hours")


def watermark_min_over_inputs(spark, sf_dir):
    rows = V.events(spark, sf_dir)
    rows = V.as_sensors(rows).select("event_id", "ts", "arrival", (F.col("event_id") % 2).alias("input"))
    return E.watermark_min_over_inputs(rows, "input", [0, 1], ARRIVAL, bound="2 hours")


def late_drop(spark, sf_dir):
    return E.late_drop(V.sensors(spark, sf_dir), "id", ARRIVAL, size="5 hours", bound="2 hours")


def late_refire(spark, sf_dir):
    return E.late_refire(
        V.sensors(spark, sf_dir), "id", ARRIVAL, size="5 hours", bound="2 hours", lateness="2 hours")


def late_side_output(spark, sf_dir):
    return E.late_rows(V.sensors(spark, sf_dir), ARRIVAL, size="5 hours", bound="2 hours", lateness="2 hours")


# -- keyed state and timers ----------------------------------------------------

def timer_per_event(spark, sf_dir):
    return K.timer_per_event(V.sensors(spark, sf_dir), "5 hours", "2 hours")


def timer_one_per_key(spark, sf_dir):
    return K.timer_one_per_key(V.sensors(spark, sf_dir), "5 hours", "2 hours")


def timer_processing(spark, sf_dir):
    return K.timer_processing(V.sensors(spark, sf_dir), "5 hours")


def timer_one_per_key_processing(spark, sf_dir):
    return K.timer_one_per_key_processing(V.sensors(spark, sf_dir), "5 hours")


def rising_alert_event(spark, sf_dir):
    return K.rising_alert_event(V.sensors(spark, sf_dir), "5 hours", "2 hours")


def rising_alert_processing(spark, sf_dir):
    return K.rising_alert_processing(V.sensors(spark, sf_dir), "10 hours")


def jump_alert(spark, sf_dir):
    return K.jump_alert(V.sensors(spark, sf_dir), 1.7)


def jump_alert_self_cleaning(spark, sf_dir):
    return K.jump_alert_self_cleaning(V.sensors(spark, sf_dir), 10, "60 hours", "2 hours")


def last_value_keyed(spark, sf_dir):
    return K.last_value(V.sensors(spark, sf_dir).select("event_id", "id", "vc", "arrival"), "id", "vc")


def last_value_global(spark, sf_dir):
    return K.last_value_global(V.sensors(spark, sf_dir).select("event_id", "id", "vc", "arrival"), "vc")


def ttl_count(spark, sf_dir):
    rows = V.sensors(spark, sf_dir).select("id", "ts", "event_id")
    return K.ttl_count(rows, "id", ("ts", "event_id"), "10 hours")


# -- metrics -------------------------------------------------------------------

COUNTER = "MapCounter"  # fixed value: the counter's name


def metric_counter(spark, sf_dir):
    return M.counter(R.tokenize(V.lines(spark, sf_dir)), COUNTER)


def metric_counter_weighted(spark, sf_dir):
    return M.counter(R.tokenize(V.lines(spark, sf_dir)), COUNTER, step=2)


def histogram_last_n(spark, sf_dir):
    return M.histogram_last(V.sensors(spark, sf_dir), "vc", ARRIVAL, 1000)


def histogram_last_500(spark, sf_dir):
    return M.histogram_last(V.sensors(spark, sf_dir), "vc", ARRIVAL, 500)


def meter_rate(spark, sf_dir):
    return M.meter_rate(V.sensors(spark, sf_dir), "ts", "60 minutes")


def meter_trailing_rates(spark, sf_dir):
    return M.trailing_rates(V.sensors(spark, sf_dir), "ts", "1 hour")


def meter_exponential_rates(spark, sf_dir):
    return M.exponential_rates(V.sensors(spark, sf_dir), "ts", "1 hour")


def delay_stats(spark, sf_dir):
    return M.delay_stats(V.sensors(spark, sf_dir), "ts", "arrival", "5 hours")


def delay_sketch(spark, sf_dir):
    """Delays of 50 hours from the sketches of 5-hour panes, and whether their ranks are within one per cent."""
    rows = V.sensors(spark, sf_dir)
    merged = M.merged_delays(M.delay_sketches(rows, "ts", "arrival", "5 hours"), "50 hours")
    errors = M.rank_errors(rows, merged, "50 hours")
    return errors.select("window_start", "n", *[(F.col(f"{c}_error") <= 0.01).alias(f"{c}_close") for c in ("p50", "p95")])


# -- sinks ---------------------------------------------------------------------

def sink_queue_payload(spark, sf_dir):
    return P.queue_payload(V.behaviors(spark, sf_dir))


def sink_jdbc_rows(spark, sf_dir):
    return P.jdbc_rows(V.behaviors(spark, sf_dir))


def sink_kv_latest(spark, sf_dir):
    return P.kv_latest(V.page_views(spark, sf_dir))


def sink_doc_upsert(spark, sf_dir):
    return P.documents(V.behaviors(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        word_count, src_text_lines, src_collection, parse_behavior_csv, parse_behavior_bad,
        parse_sensor_csv, parse_threshold_json, map_project, map_with_lifecycle, filter_pv,
        flatmap_tokenize, key_partition_stats, format_window_text, epoch_convert, process_element,
        union_streams, connect_comap, gate_forward, gate_forward_extend, dynamic_threshold_alert,
        side_output_main, side_output_alarm, rolling_sum, rolling_reduce, rolling_reduce_general, pv_total, uv_bitmap,
        window_user_aggregate, session_user_aggregate, delay_sketch,
        pv_total_running, uv_total, uv_running, uv_approx, channel_behavior_count,
        channel_behavior_running, pv_per_user, count_average, buffer_release, tumbling_count,
        sliding_count, session_count, count_window_tumbling, count_window_sliding,
        window_reduce_sum, window_aggregate_count, window_avg, window_minmax,
        window_minmax_incremental, window_count_text, watermark_ascending, watermark_bounded,
        watermark_per_record, watermark_per_batch, watermark_min_over_inputs, late_drop,
        late_refire, late_side_output, timer_per_event, timer_one_per_key, timer_processing,
        timer_one_per_key_processing, rising_alert_event, rising_alert_processing, jump_alert,
        jump_alert_self_cleaning, last_value_keyed, last_value_global, ttl_count, metric_counter,
        metric_counter_weighted, histogram_last_n, histogram_last_500, meter_rate,
        meter_trailing_rates, meter_exponential_rates, delay_stats, sink_queue_payload, sink_jdbc_rows, sink_kv_latest,
        sink_doc_upsert,
    )
}
QUERIES["rolling_min"] = _extreme("min", whole=False)
QUERIES["rolling_max"] = _extreme("max", whole=False)
QUERIES["rolling_min_by"] = _extreme("min", whole=True)
QUERIES["rolling_max_by"] = _extreme("max", whole=True)
