"""The sensor fixture against answers worked out by hand."""

from collections import Counter

from feeds import READINGS, at, clock, sensor_frame

from brook.operators import eventtime as E
from brook.operators import keyed as K
from brook.operators import rolling as R
from brook.operators import windows as W

ARRIVAL = ("arrival", "event_id")


def test_tumbling_count(readings):
    got = {(r.id[-1], clock(r.window_start), r.n) for r in W.tumbling_count(readings, "id").collect()}
    assert got == {("1", 44120, 3), ("1", 44125, 2), ("2", 44125, 2), ("3", 44125, 1),
                   ("3", 44130, 2), ("3", 54130, 1)}


def test_window_minmax_avg(readings):
    rows = W.window_minmax(readings, "id", "vc", size="5 seconds").collect()
    got = {(r.id[-1], clock(r.window_start)): (r.min, r.max) for r in rows}
    assert got == {("1", 44120): (10, 30), ("1", 44125): (50, 70), ("2", 44125): (40, 60),
                   ("3", 44125): (80, 80), ("3", 44130): (90, 90), ("3", 54130): (90, 90)}
    avg = {r.avg for r in W.window_average(readings, "id", "vc", size="5 seconds").collect()}
    assert avg == {20, 60, 50, 80, 90}


def test_jump_alert(readings):
    got = [(r.id[-1], r.vc, r.diff) for r in K.jump_alert(readings).orderBy("event_id").collect()]
    assert got == [("1", 10, 10), ("1", 20, 10), ("1", 30, 10), ("2", 40, 40), ("1", 50, 20),
                   ("2", 60, 20), ("1", 70, 20), ("3", 80, 80), ("3", 90, 10)]


def test_self_cleaning_jump_alert(readings):
    got = [(r.id[-1], r.vc, r.diff) for r in K.jump_alert_self_cleaning(readings).orderBy("event_id").collect()]
    assert got == [("2", 40, 40), ("1", 50, 20), ("2", 60, 20), ("1", 70, 20), ("3", 80, 80)]


def test_self_cleaning_forgets(spark):
    # s2 moves the watermark to 98, past s1's timer at 70; s1 then starts from 0.
    rows = sensor_frame(spark, [("s1", 10, 50, 1), ("s2", 100, 5, 2), ("s1", 101, 50, 3), ("s1", 102, 50, 4)])
    got = K.jump_alert_self_cleaning(rows).select("event_id", "diff").orderBy("event_id").collect()
    assert [tuple(r) for r in got] == [(0, 50), (2, 50)]


def test_count_average(readings):
    got = sorted((r.id[-1], r.block, r.n, r.avg) for r in R.count_average(readings, "id", ARRIVAL, "vc").collect())
    assert got == [("1", 0, 2, 15), ("1", 1, 2, 40), ("2", 0, 2, 50), ("3", 0, 2, 85), ("3", 1, 2, 90)]


def test_buffer_of_three(readings):
    got = sorted((r.event_id, r.batch_no) for r in R.buffer_release(readings, ARRIVAL).collect())
    assert got == [(i, i // 3) for i in range(9)]


def test_one_timer_per_key(readings):
    got = K.timer_one_per_key(readings, keep_open=True).collect()
    assert {(r.id[-1], clock(r.fire_time)) for r in got if r.fired} == {("1", 44127), ("2", 44130), ("3", 44134)}
    # Every key's one timer is fired by the jump to 54131; no row comes after it.
    assert all(r.fired for r in got)


def test_rising_alert_event(readings):
    got = K.rising_alert_event(readings, keep_open=True).collect()
    assert {(r.id[-1], clock(r.fire_time)) for r in got if r.fired} == {("1", 44127), ("2", 44130)}
    assert {(r.id[-1], clock(r.fire_time)) for r in got if not r.fired} == {("3", 54136)}


LATE = [("s1", 1), ("s1", 4), ("s1", 7), ("s1", 3), ("s1", 8), ("s1", 2), ("s1", 9), ("s1", 4), ("s2", 20)]


def late_frame(spark):
    return sensor_frame(spark, [(k, s, 0, 100 + i) for i, (k, s) in enumerate(LATE)])


def test_row_classes(spark):
    rows = E.classify(late_frame(spark), ARRIVAL, lateness="2 seconds").orderBy("event_id").collect()
    assert [r.row_class for r in rows] == [
        "on_time", "on_time", "on_time", "refire", "on_time", "refire", "on_time", "late", "on_time"]
    wm = [None if r.wm_before is None else (r.wm_before - at(0)).total_seconds() for r in rows]
    assert wm == [None, -1, 2, 5, 5, 6, 6, 7, 7]


def test_late_policies(spark):
    df = late_frame(spark)
    dropped = {(r.id, clock(r.window_start) + 1549000000, r.n) for r in E.late_drop(df, "id", ARRIVAL).collect()}
    assert dropped == {("s1", 0, 2), ("s1", 5, 3)}
    flushed = {(r.id, r.n) for r in E.late_drop(df, "id", ARRIVAL, flush=True).collect()}
    assert flushed == {("s1", 2), ("s1", 3), ("s2", 1)}
    fired = sorted((r.firing, r.n) for r in E.late_refire(df, "id", ARRIVAL).collect())
    assert fired == [("first", 2), ("first", 3), ("refire", 3), ("refire", 4)]
    assert [r.event_id for r in E.late_rows(df, ARRIVAL).collect()] == [7]


def test_min_watermark_waits_for_slow_input(spark):
    df = sensor_frame(spark, [("a", 10, 0, 1), ("a", 20, 0, 2), ("b", 5, 0, 3), ("b", 30, 0, 4)])
    got = E.watermark_min_over_inputs(df, "id", ["a", "b"], ARRIVAL).orderBy("event_id").collect()
    assert [r.watermark and (r.watermark - at(0)).total_seconds() for r in got] == [None, None, 3, 18]


def test_sliding_and_count_windows(readings):
    n = sum(r.n for r in W.sliding_count(readings, "id").collect())
    assert n == 10 * len(READINGS)
    got = sorted((r.id[-1], r.firing, r.n) for r in W.count_window(readings, "id", ARRIVAL, 5, 2).collect())
    assert got == [("1", 1, 2), ("1", 2, 4), ("2", 1, 2), ("3", 1, 2), ("3", 2, 4)]
    full = [(r.id[-1], r.n) for r in W.count_window(readings, "id", ARRIVAL, 5).collect()]
    assert full == [("1", 5)]


def test_session_gap_is_inclusive(spark):
    df = sensor_frame(spark, [("a", 0, 0), ("a", 5, 0), ("a", 11, 0)])
    got = sorted((clock(r.session_start) + 1549000000, clock(r.session_end) + 1549000000, r.n)
                 for r in W.session_count(df, "id", ("ts", "event_id")).collect())
    assert got == [(0, 10, 2), (11, 16, 1)]


def test_word_count(spark):
    lines = spark.createDataFrame([("to be, or NOT to be",), ("  that-is ",), ("",)], "line string")
    got = {r.word: r.n for r in R.word_count(lines).collect()}
    assert got == Counter("to be or not to be that is".split())


def test_aggregate_of_four_methods(spark, readings):
    got = W.user_aggregate(
        readings, ["id"], "ts", "5 seconds",
        zero=lambda: (0.0, 0), add=lambda a, r: (a[0] + r.vc, a[1] + 1),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]), result=lambda a: (a[0] / a[1],),
        accumulator="s double, n bigint", output="avg double")
    want = W.window_average(readings, "id", "vc", size="5 seconds").select("id", "window_start", "avg")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
