"""Composed timer machines against the plain fold, and the layout they and running values rest on."""

import random

import numpy as np
import pyarrow as pa
import pytest
from feeds import SF, sensor_frame
from pyspark.sql import functions as F
from test_machines import Model, feed, fired

from brook.operators import keyed as K
from brook.operators import machines as M
from brook.operators import scan as S
from brook.operators import timers
from brook.sources import views as V

ARRIVAL = ("arrival", "event_id")


def plain(ticks, timer):
    """(firings, timer left) of the fold, from a pending timer."""
    times = []
    for clock, sets, breaks in ticks:
        if M.is_due(timer, clock):
            times.append(timer.time)
            timer = None
        if breaks:
            timer = None
        if timer is None and sets is not None:
            timer = M.set_timer(sets, clock)
    return times, timer


@pytest.mark.parametrize("seed", range(40))
def test_a_run_of_ticks_is_a_function(seed):
    rng = random.Random(seed)
    clocks = sorted(rng.sample(range(60), rng.randrange(1, 25)))
    share = rng.choice([0, 0, 0.1, 0.4])
    ticks = [(c, rng.choice([None, c + rng.randrange(-3, 15)]), rng.random() < share) for c in clocks]
    run = timers.Ticks.of(pa.table({
        "clock": pa.array([t[0] for t in ticks], pa.int64()), "sets": pa.array([t[1] for t in ticks], pa.int64()),
        "breaks": pa.array([t[2] for t in ticks])}))
    possible = run.possible_exits()
    for due in [None, *range(1, 75)]:
        times, left = plain(ticks, None if due is None else M.Timer(1000 + due, due))
        at = (timers.NONE, timers.NONE) if due is None else (1000 + due, due)
        assert run.walk(*at) == times
        end = run.exit(*at)
        assert end == ((timers.NONE, timers.NONE) if left is None else tuple(left))
        assert end in possible or end == at
    assert len(possible) == len(set(possible))
    if any(t[2] for t in ticks):
        assert len(possible) == 1  # a break makes every entry one


@pytest.fixture
def slice_rows(spark):
    def use(n):
        spark.conf.set(S.ROWS_PER_SLICE_CONF, str(n))

    yield use
    spark.conf.unset(S.ROWS_PER_SLICE_CONF)


def models():
    def rising(s, timer, ts, vc):
        return ts + 5 if timer is None or (s["last"] is not None and vc <= s["last"]) else None

    def rising_clock(s, timer, now, vc):
        if s["last"] == 0:
            return timer
        if vc < s["last"]:
            return None
        return now + 10 if vc > s["last"] and timer is None else timer

    return {
        "event": (K.timer_one_per_key, lambda m: m.run_event(lambda s, t, ts, vc: None if t is not None else ts + 5)),
        "clock": (K.timer_one_per_key_processing, lambda m: m.run_clock(lambda s, t, now, vc: t if t is not None else now + 5)),
        "rising": (K.rising_alert_event, lambda m: m.run_event(rising)),
        "rising_clock": (K.rising_alert_processing, lambda m: m.run_clock(rising_clock)),
    }


@pytest.mark.parametrize("name", models())
@pytest.mark.parametrize(("seed", "rows"), [(11, 12)])
def test_sliced_machines(spark, slice_rows, name, seed, rows):
    data = feed(seed, n=220, keys=3, levels=30)
    operator, model = models()[name]
    slice_rows(rows)
    got = operator(sensor_frame(spark, data))
    assert fired(got) == model(Model(data, 2))


def test_open_timers_of_sliced_keys(spark, slice_rows):
    data = feed(13, n=200, keys=2)
    frame = sensor_frame(spark, data)
    want = sorted(map(tuple, K.timer_one_per_key_processing(frame, "9 seconds", keep_open=True).collect()))
    slice_rows(12)
    assert sorted(map(tuple, K.timer_one_per_key_processing(frame, "9 seconds", keep_open=True).collect())) == want
    assert {w[2] for w in want} == {True, False}


def test_one_key_is_spread_over_tasks(spark):
    """Every step of the composed machine deals a key's ticks by slice."""
    data = feed(14, n=400, keys=1)
    ticks = sensor_frame(spark, data).select("id", F.unix_micros(F.col("arrival").cast("timestamp")).alias("clock")).distinct()
    laid = S.scan(ticks, ["id"], ["clock"], 20)
    sizes = [r["count"] for r in laid.df.groupBy(S.SLICE).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 0.4 * sum(sizes)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def values(scan):
    vc = F.col("vc")
    return scan.add(pos=S.position(), sm=S.total(vc), prev=S.previous(vc), nxt=S.following(vc),
                    known=S.latest(F.when(vc % 3 == 0, vc)), ahead=S.next_known(F.when(vc % 5 == 0, vc))).rows()


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of all rows at one instant of one key."""
    rows = V.sensors(spark, SF)
    third = F.col("event_id") % 3 == 0
    return rows.withColumn("arrival", F.when(third, F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).otherwise(
        F.col("arrival"))).withColumn("id", F.when(third, "hot").otherwise(F.col("id"))).cache()


@pytest.mark.parametrize("keys", [[], ["id"]])
def test_one_instant_is_cut(crowded, keys):
    cut = S.scan(crowded, keys, ARRIVAL, 20)
    at = [r["count"] for r in cut.df.where("event_id % 3 = 0").groupBy(S.SLICE).count().collect()]
    assert len(at) > 5 and max(at) < 0.4 * sum(at)
    want = S.scan(crowded, keys, ARRIVAL, 10**9) if keys else S.scan(crowded.withColumn("one", F.lit(1)), ["one"], ARRIVAL, 10**9)
    assert rows_of(values(cut)) == rows_of(values(want).drop("one"))


def test_instants_of_timers_are_cut(spark, slice_rows):
    data = [("s1", 100, i % 7, 100) for i in range(300)] + [(f"s{i % 5}", 50 + i, 1, 50 + i) for i in range(150)]
    frame = sensor_frame(spark, data)
    want = rows_of(K.timer_per_event(frame))
    slice_rows(10)
    assert rows_of(K.timer_per_event(frame)) == want and want


@pytest.mark.parametrize(("fan", "first", "local", "broadcast"), [(4, 8, 3, 30_000), (256, 512, 1_000, 0)])
def test_any_number_of_hot_keys_and_slices(spark, monkeypatch, fan, first, local, broadcast):
    """More hot keys than a plan holds, keys cut more than once, and a summary too large to broadcast."""
    for name, value in (("FAN", fan), ("FIRST_FAN", first), ("LOCAL_ROWS", local), ("BROADCAST_SLICES", broadcast)):
        monkeypatch.setattr(S, name, value)
    rows = V.sensors(spark, SF).withColumn("id", F.when(F.col("event_id") % 2 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("event_id") % 14)))
    cut = S.scan(rows, ["id"], ARRIVAL, 12)
    spread = cut.df.groupBy("id").agg(F.countDistinct(S.SLICE).alias("n"), F.count("*").alias("rows"))
    assert spread.where("rows > 36 and n < 2").count() == 0 and spread.where("n > 1").count() >= 8
    assert spread.where("id = 'hot'").first().n > 4 * fan if fan < 10 else True
    assert rows_of(values(cut)) == rows_of(values(S.scan(rows, ["id"], ARRIVAL, 10**9)))
    whole = S.scan(rows, [], ARRIVAL, 12)
    plain_rows = S.scan(rows.withColumn("one", F.lit(1)), ["one"], ARRIVAL, 10**9)
    assert whole.df.select(S.SLICE).distinct().count() > 3 * first if first < 10 else True
    assert rows_of(values(whole)) == rows_of(values(plain_rows).drop("one"))


def test_slices_keep_the_order(crowded):
    cut = S.scan(crowded, [], ARRIVAL, 15).df.select(S.SLICE, *ARRIVAL).orderBy(*ARRIVAL).collect()
    numbers = np.array([r[S.SLICE] for r in cut])
    assert (np.diff(numbers) >= 0).all()
