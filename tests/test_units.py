"""Parsing, text, durations and sink payloads."""

import json

import pytest
from feeds import at
from pyspark.sql import functions as F

from brook import session
from brook.functions import durations as D
from brook.functions.text import window_text
from brook.operators import multi as C
from brook.operators.rolling import approximate_distinct
from brook.operators.rowwise import map_with_lifecycle
from brook.sinks import payloads
from brook.sources import parse


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "line string")


def test_durations(spark):
    assert D.micros("5 seconds") == 5_000_000 and D.micros("1 millisecond") == 1000
    row = spark.range(1).select(
        (D.from_seconds(F.lit(0)) + D.interval("2 hours")).alias("a"),
        D.to_micros(D.from_seconds(F.lit(3))).alias("b"), D.from_micros(F.lit(1_500_000)).alias("c")).first()
    assert (row.a, row.b, row.c) == (at(7200), 3_000_000, at(1.5))


def test_behavior_csv(spark):
    good, bad = parse.behavior_csv(lines(
        spark, "606403,1404468,781315,pv,1511658000", "x,1,2,pv,3", "1,2,3,pv", "1,2,3,pv,1511658009"))
    assert sorted((r.user_id, r.item_id, r.category_id, r.behavior, r.ts) for r in good.collect()) == [
        (1, 2, 3, "pv", at(1511658009)), (606403, 1404468, 781315, "pv", at(1511658000))]
    assert sorted(r.line for r in bad.collect()) == ["1,2,3,pv", "x,1,2,pv,3"]


def test_sensor_csv(spark):
    good, bad = parse.sensor_csv(lines(spark, "sensor_1,1549044122,10", "", "sensor_1,abc,1"))
    assert [(r.id, r.ts, r.vc) for r in good.collect()] == [("sensor_1", at(1549044122), 10)]
    assert bad.count() == 2


def test_threshold_json(spark):
    got = parse.threshold_json(lines(
        spark, '{"id": "sensor_1", "thresholdVc": 15}', '{"id": ', "null", "", '{"id": "a", "thresholdVc": 0}'))
    assert sorted(map(tuple, got.collect())) == [("a", 0), ("sensor_1", 15)]


def test_window_text(spark):
    row = spark.range(1).select(window_text(
        F.lit("k"), D.from_seconds(F.lit(0)), D.from_micros(F.lit(5_250_000)), F.lit(3)).alias("t")).first()
    assert row.t == "key=k window=[1970-01-01 00:00:00.000,1970-01-01 00:00:05.250) n=3"


def test_lifecycle(spark, tmp_path):
    trace = tmp_path / "trace"

    def note(text):
        with open(trace, "a") as out:
            out.write(text)

    def opened():
        note("o")
        return 10

    got = map_with_lifecycle(
        spark.range(0, 4, 1, 1), opened, lambda k, pdf: pdf.assign(id=pdf.id * k), lambda k: note("c"), "id bigint")
    assert sorted(r.id for r in got.collect()) == [0, 10, 20, 30]
    assert trace.read_text() == "oc"


def test_payloads(spark):
    rows = spark.createDataFrame(
        [(1, 10, 3, "pv", at(5)), (1, 11, 3, "buy", at(6)), (2, 12, 3, "pv", at(1))],
        "user_id bigint, item_id bigint, category_id int, behavior string, ts timestamp_ntz")
    first = json.loads(payloads.queue_payload(rows.where("item_id = 10")).first().value)
    assert first == {"user_id": 1, "item_id": 10, "category_id": 3, "behavior": "pv", "ts": 5000}
    assert payloads.jdbc_rows(rows).dtypes == [("user_id", "int"), ("item_id", "string"), ("behavior", "string")]
    docs = {r.doc_id: json.loads(r.source) for r in payloads.documents(rows).collect()}
    assert docs["1"] == {"userID": "1", "itemId": "11", "behavior": "buy"}
    assert dict(map(tuple, payloads.kv_latest(rows).collect())) == {"1": "2", "2": "1"}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_static_rules(spark, threshold):
    """The same with the rule table broadcast or, when the engine finds it too large, joined by key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    jumps = spark.createDataFrame([("a", 5, 12), ("a", 6, 3), ("b", 7, 99)], "id string, vc int, diff int")
    rules = spark.createDataFrame([("a", 10), ("b", 0)], "id string, threshold_vc int")
    got = C.static_threshold_alert(jumps, rules).collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [tuple(r) for r in got] == [("a", 5, 12)]


def test_gate_rules(spark):
    """The earliest expiry closes; at one instant: expiry, then switch, then reading."""
    switch = spark.createDataFrame(
        [(1, "a", 10_000, at(0)), (2, "a", 2_000, at(1)), (3, "a", 5_000, at(10))],
        "event_id bigint, id string, duration_ms bigint, arrival timestamp_ntz")
    times = [0, 2, 3, 5, 10, 12, 15]
    reading = spark.createDataFrame(
        [(i, "a", t, at(t)) for i, t in enumerate(times)],
        "event_id bigint, id string, vc int, arrival timestamp_ntz")
    assert sorted(r.vc for r in C.gate_forward(reading, switch).collect()) == [0, 2, 10, 12]
    assert sorted(r.vc for r in C.gate_forward(reading, switch, extend=True).collect()) == [0, 2, 3, 5, 10, 12]


def test_shared_folder_is_taken_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    made = session.shared_dir(spark, "x")
    assert made.startswith(root if root else "/") and made != session.shared_dir(spark, "x")


def test_user_ids_wrap_around(spark):
    rows = spark.createDataFrame(
        [(2**31, 1, "b"), (2**32 + 5, 1, "b"), (-1, 1, "b"), (7, 1, "b"), (None, 1, "b")],
        "user_id bigint, item_id bigint, behavior string")
    assert [r.user_id for r in payloads.jdbc_rows(rows).collect()] == [-(2**31), 5, -1, 7, None]


@pytest.mark.parametrize("n", [0, 1, 50, 5_000, 12_000, 40_000, 1_000_000])
def test_approximate_distinct_error(spark, n):
    rows = spark.range(n).select((F.col("id") * 7919).alias("u")).unionAll(spark.range(min(n, 100)).select(F.col("id") * 7919))
    got = approximate_distinct(rows, "u").first().uv
    assert abs(got - n) <= max(0.5, 4 * n / 64)
