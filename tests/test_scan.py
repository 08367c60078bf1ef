"""Running values give the same answer however the rows are sliced."""

import pytest
from feeds import SF
from pyspark.sql import functions as F

from brook.operators import eventtime as E
from brook.operators import keyed as K
from brook.operators import multi as C
from brook.operators import rolling as R
from brook.operators import scan as S
from brook.operators import windows as W
from brook.sources import views as V

ARRIVAL = ("arrival", "event_id")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, another share under no key at all."""
    key = F.when(F.col("event_id") % 3 == 0, "sensor_hot").when(F.col("event_id") % 7 == 1, None).otherwise(F.col("id"))
    return V.sensors(spark, SF).withColumn("id", key).cache()


@pytest.fixture
def slice_rows(spark):
    def use(n):
        spark.conf.set(S.ROWS_PER_SLICE_CONF, str(n))

    yield use
    spark.conf.unset(S.ROWS_PER_SLICE_CONF)


def all_values(scan):
    vc = F.col("vc")
    return scan.add(
        pos=S.position(), sm=S.total(vc), before=S.total(vc, before=True), top=S.highest(F.col("ts"), before=True),
        low=S.lowest(F.struct("vc", "event_id")), prev=S.previous(vc), nxt=S.following(vc),
        known=S.latest(F.when(vc % 3 == 0, vc)), ahead=S.next_known(F.when(vc % 5 == 0, vc)),
    ).rows()


@pytest.mark.parametrize("size", [11, 40, 200])
def test_keyed_values_do_not_depend_on_slices(skewed, size):
    whole = S.scan(skewed, ["id"], ARRIVAL, 10**9)
    cut = S.scan(skewed, ["id"], ARRIVAL, size)
    assert not whole.sliced and cut.sliced
    assert rows_of(all_values(whole)) == rows_of(all_values(cut))


def test_hot_key_is_spread(skewed):
    cut = S.scan(skewed, ["id"], ARRIVAL, 20)
    hot = cut.df.where("id = 'sensor_hot'").groupBy(S.SLICE).count().collect()
    assert len(hot) > 5
    assert max(r["count"] for r in hot) < 0.3 * sum(r["count"] for r in hot)


def test_slices_are_even_for_a_burst(skewed):
    """A hot key whose rows all fall into one hour is still cut evenly."""
    hour = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    burst = skewed.withColumn("arrival", F.when(
        F.col("id") == "sensor_hot", hour + F.make_dt_interval(secs=F.col("event_id"))).otherwise(F.col("arrival")))
    cut = S.scan(burst, ["id"], ARRIVAL, 20)
    hot = [r["count"] for r in cut.df.where("id = 'sensor_hot'").groupBy(S.SLICE).count().collect()]
    assert len(hot) > 5 and max(hot) < 3 * sum(hot) / len(hot)
    assert rows_of(all_values(cut)) == rows_of(all_values(S.scan(burst, ["id"], ARRIVAL, 10**9)))


def test_global_values_match_plain_python(skewed):
    got = all_values(S.scan(skewed, [], ARRIVAL, 25)).orderBy(*ARRIVAL).collect()
    total, prev, top = 0, None, None
    for i, r in enumerate(got):
        total += r.vc
        assert (r.pos, r.sm, r.before, r.prev, r.top) == (i + 1, total, total - r.vc, prev, top)
        prev = r.vc
        top = r.ts if top is None else max(top, r.ts)
    ahead = None
    for r in reversed(got):
        ahead = r.vc if r.vc % 5 == 0 else ahead
        assert r.ahead == ahead


def test_one_instant_holds_a_third_of_the_rows(spark, skewed):
    """Slices cannot cut one instant; the answer must stand all the same."""
    burst = skewed.withColumn("arrival", F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-10 00:00:00").cast(
        "timestamp_ntz")).otherwise(F.col("arrival")))
    assert rows_of(all_values(S.scan(burst, ["id"], ARRIVAL, 10**9))) == rows_of(
        all_values(S.scan(burst, ["id"], ARRIVAL, 17)))


def test_empty_input(skewed):
    nothing = skewed.where("false")
    assert all_values(S.scan(nothing, [], ARRIVAL)).count() == 0
    assert all_values(S.scan(nothing, ["id"], ARRIVAL)).count() == 0


def test_any_combiner(skewed):
    """An associative combiner that does not commute: keep the leftmost, add up the rest."""
    df = skewed.where("id is not null").select("id", "event_id", "arrival", F.col("vc").cast("string").alias("vc"))
    got = {}
    for size in (10**9, 25):
        df.sparkSession.conf.set(S.ROWS_PER_SLICE_CONF, str(size))
        out = R.rolling_fold(df, ["id"], ARRIVAL, "vc", lambda a, b: a + "," + b)
        got[size] = sorted((r.event_id, r.running) for r in out.collect())
    df.sparkSession.conf.unset(S.ROWS_PER_SLICE_CONF)
    assert got[25] == got[10**9]
    held, want = {}, []
    for r in df.orderBy(*ARRIVAL).collect():
        held[r.id] = held[r.id] + "," + r.vc if r.id in held else r.vc
        want.append((r.event_id, held[r.id]))
    assert got[25] == sorted(want)


OPERATORS = {
    "rolling_min_by": lambda d: R.rolling_extreme(d, ["id"], ARRIVAL, "vc", "min", ["vc", "event_id"]),
    "rolling_max_by": lambda d: R.rolling_extreme(d, ["id"], ARRIVAL, "vc", "max", ["vc", "event_id"]),
    "running_distinct": lambda d: R.running_distinct(d.select("id", *ARRIVAL), "id", ARRIVAL),
    "count_average": lambda d: R.count_average(d, "id", ARRIVAL, "vc"),
    "session_count": lambda d: W.session_count(d, "id", ("ts", "event_id"), "5 hours"),
    "late_refire": lambda d: E.late_refire(d, "id", ARRIVAL, size="5 hours", bound="2 hours", lateness="2 hours"),
    "jump_self_cleaning": lambda d: K.jump_alert_self_cleaning(d, 10, "60 hours", "2 hours"),
    "timer_per_event": lambda d: K.timer_per_event(d, "5 hours", "2 hours"),
    "timer_one_per_key": lambda d: K.timer_one_per_key(d, "5 hours", "2 hours"),
    "rising_event": lambda d: K.rising_alert_event(d, "5 hours", "2 hours"),
    "rising_processing": lambda d: K.rising_alert_processing(d, "10 hours"),
    "ttl_count": lambda d: K.ttl_count(d.select("id", *ARRIVAL), "id", ARRIVAL, "10 hours"),
    "thresholds": lambda d: C.dynamic_threshold_alert(
        d, d.where("vc % 4 = 0").select("event_id", "id", (F.col("vc") % 40).alias("threshold_vc"), "arrival")),
    "gate": lambda d: C.gate_forward(
        d, d.where("vc % 6 = 0").select("event_id", "id", F.lit(7_200_000).cast("bigint").alias("duration_ms"), "arrival")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_under_skew(skewed, slice_rows, name):
    df = skewed.where("id is not null")
    slice_rows(10**9)
    plain = rows_of(OPERATORS[name](df))
    slice_rows(30)
    assert plain and rows_of(OPERATORS[name](df)) == plain


@pytest.mark.parametrize(("name", "passes"), [("late_drop", 1), ("buffer", 1), ("timer_one_per_key", 1), ("late_refire", 2)])
def test_eager_passes(skewed, monkeypatch, name, passes):
    """Row count, boundaries and the last watermark come from one pass; a keyed value adds its count per key."""
    seen = []
    kind = type(skewed)
    for action in ("first", "collect", "count", "toArrow"):
        plain = getattr(kind, action)

        def counted(self, *args, plain=plain):
            if not seen or seen[-1] != "inside":
                seen.append("inside")
                try:
                    return plain(self, *args)
                finally:
                    seen[-1] = "done"
            return plain(self, *args)

        monkeypatch.setattr(kind, action, counted)
    df = skewed.where("id is not null")
    {
        "late_drop": lambda: E.late_drop(df, "id", ARRIVAL),
        "buffer": lambda: R.buffer_release(df, ARRIVAL),
        "timer_one_per_key": lambda: K.timer_one_per_key(df),
        "late_refire": lambda: E.late_refire(df, "id", ARRIVAL),
    }[name]()
    assert len(seen) == passes
