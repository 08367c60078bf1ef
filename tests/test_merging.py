"""Values that merge: parallel prefixes, affine rates, bitmaps, sketches, sessions out of order."""

import math
import random

import pytest
from feeds import SF, at
from pyspark.sql import functions as F

from brook.operators import metrics as M
from brook.operators import rolling as R
from brook.operators import scan as S
from brook.operators import windows as W
from brook.plans.queries import LEVELS
from brook.sources import views as V


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_prefixes_of_a_growing_combiner(spark, n):
    """What comes before each place, in order, for keys of different length."""
    rows = [(k, 10 * i + k, f"{k}.{i}") for k in range(3) for i in range(n - k if n > 3 else n)]
    frame = spark.createDataFrame(rows, "g long, p long, v string").repartition(3)
    got = R.prefixes(frame, "v", lambda a, b: F.concat(a, F.lit(","), b), ["g"], "p").collect()
    want = {}
    for k, p, v in rows:
        before = [x for g, q, x in rows if g == k and q < p]
        if before:
            want[k, p] = ",".join(before)
    assert {(r.g, r.p): r.v for r in got} == want


def test_general_reduce_of_a_hot_key_runs_on_the_executors(spark, monkeypatch):
    """No slice's value passes through the driver."""
    rows = V.sensors(spark, SF).select("event_id", F.lit("hot").alias("id"), "arrival", F.col("vc").cast("string").alias("v"))
    spark.conf.set(S.ROWS_PER_SLICE_CONF, "50")
    try:
        plain = type(rows).collect

        def guarded(self):
            assert not {"v", "_v", "_before", "running"} & set(self.columns)
            return plain(self)

        monkeypatch.setattr(type(rows), "collect", guarded)
        out = R.rolling_fold(rows, ["id"], ("arrival", "event_id"), "v", lambda a, b: (a + b)[-40:])
        monkeypatch.undo()
        got = {r.event_id: r.running for r in out.collect()}
    finally:
        spark.conf.unset(S.ROWS_PER_SLICE_CONF)
    held, want = "", {}
    for r in rows.orderBy("arrival", "event_id").collect():
        held = (held + r.v)[-40:] if held else r.v
        want[r.event_id] = held
    assert got == want


def plain_rates(counts, spans):
    out, rates = {}, None
    for t in range(min(counts), max(counts) + 1):
        n = counts.get(t, 0)
        rates = [float(n)] * len(spans) if rates is None else [
            r * math.exp(-1 / k) + (1 - math.exp(-1 / k)) * n for r, k in zip(rates, spans)]
        out[t] = rates
    return out


def test_rates_with_gaps_and_steps_before_1970(spark):
    rng = random.Random(5)
    seconds = sorted(rng.sample(range(-4_000, 4_000), 300)) + [9_000, 9_000]
    rows = spark.createDataFrame([(at(s),) for s in seconds] + [(None,)], "ts timestamp_ntz")
    got = {r.step_start: r for r in M.exponential_rates(rows, "ts", "7 seconds").collect()}
    counts = {}
    for s in seconds:
        counts[s // 7] = counts.get(s // 7, 0) + 1
    want = plain_rates(counts, (1, 5, 15))
    assert len(got) == len(want)
    for t, rates in want.items():
        r = got[at(7 * t)]
        assert [r.rate_1, r.rate_5, r.rate_15] == pytest.approx(rates, abs=2e-6)


def test_rates_of_a_million_steps(spark):
    """Equal to a plain recursion, with counts so large that nothing old may be forgotten."""
    n = 1_000_000
    many = 10**9
    steps = spark.range(n).where("id % 1000 <> 7").select(F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"))
    got = M.exponential_rates(steps, "ts", "1 second")
    a, r = math.exp(-1 / 15), 1.0
    marks = {}
    for t in range(1, n):
        r = a * r + (1 - a) * (t % 1000 != 7)
        if t % 99_991 == 0:
            marks[t] = r
    found = got.where(F.unix_seconds(F.col("step_start").cast("timestamp")).isin(list(marks))).collect()
    assert got.count() == n and len(found) == len(marks)
    for x in found:
        t = int((x.step_start - at(0)).total_seconds())
        assert x.rate_15 == pytest.approx(marks[t], abs=1e-6)
    # A weight of e^-28 of very many events still counts.
    first = M.exponential_rates(spark.createDataFrame([(at(0),), (at(30),)], "ts timestamp_ntz"), "ts", "1 second", (1,))
    last = first.where(F.col("step_start") == at(30)).first().rate_1
    assert last == pytest.approx(1 - math.exp(-1), abs=1e-6) and many * math.exp(-28) > 1e-6


def test_a_far_outlier_is_listed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(M, "PIECE", 100)
    rows = spark.createDataFrame([(at(0),), (at(1),), (at(25_000),)], "ts timestamp_ntz")
    got = M.exponential_rates(rows, "ts", "1 second", (5,))
    assert got.count() == 25_001 and got.select("step_start").distinct().count() == 25_001
    assert M.exponential_rates(rows.limit(0), "ts", "1 second", (5,)).count() == 0


def test_bitmaps_merge_over_windows(spark):
    rows = [(i % 4, m) for i, m in enumerate([0, 1, 1, 32_767, 32_768, 32_769, 5_000_000_000, -1, -32_768, None, 0, 1, 7, 7])]
    frame = spark.createDataFrame(rows, "w long, m long")
    panes = R.bitmap_members(frame, "m", [F.col("w")])
    got = {r.w: r.uv for r in R.count_bitmaps(panes, "w").collect()}
    assert got == {w: len({m for v, m in rows if v == w and m is not None}) for w in range(4)}
    total = R.count_bitmaps(R.merge_bitmaps(panes)).first().uv
    assert total == len({m for _, m in rows if m is not None})
    halves = R.merge_bitmaps(R.bitmap_members(frame.where("w < 2"), "m").unionByName(R.bitmap_members(frame.where("w >= 2"), "m")))
    assert R.count_bitmaps(halves).first().uv == total  # batches merge as windows do
    assert R.count_bitmaps(R.bitmap_members(frame.limit(0), "m")).first().uv == 0


@pytest.mark.parametrize("shape", ["even", "heavy", "ties"])
def test_sketch_ranks(spark, shape):
    """Ranks of merged panes are within 0.5 per cent, far within the one per cent that is promised."""
    value = {"even": F.col("id") % 3_600, "heavy": F.pow(F.rand(3), 9) * 1e6, "ties": (F.col("id") % 5) * 100}[shape]
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rows = spark.range(200_000).select(
        (start + F.make_dt_interval(secs=F.col("id") % 7_200)).alias("ts"), value.cast("bigint").alias("d"))
    rows = rows.withColumn("arrival", F.col("ts") + F.make_dt_interval(secs=F.col("d")))
    panes = M.delay_sketches(rows, "ts", "arrival", "10 minutes")
    assert panes.count() == 12 and panes.select(F.max(F.length("sketch"))).first()[0] < 40_000
    merged = M.merged_delays(panes, "1 hour", (0.01, 0.5, 0.95, 0.99))
    errors = M.rank_errors(rows, merged, "1 hour", (0.01, 0.5, 0.95, 0.99)).collect()
    assert len(errors) == 2
    for r in errors:
        assert max(r.p1_error, r.p50_error, r.p95_error, r.p99_error) <= 0.005


@pytest.mark.parametrize("batch", [3, 10_000])
def test_sessions_grow_together_out_of_order(spark, batch):
    """A late row closes the gap between two sessions, within an Arrow batch and between tasks."""
    rng = random.Random(9)
    rows = [("a", s, i) for i, s in enumerate([0, 20, 10, 100, 120, 109, 111, 300])]
    rows += [(f"k{rng.randrange(3)}", rng.randrange(0, 900), i) for i in range(150)] + [(None, 5, 1), (None, 9, 2)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(k, at(s), v) for k, s, v in rows], "id string, ts timestamp_ntz, vc int").repartition(4)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(batch))
    spark.conf.set(S.ROWS_PER_SLICE_CONF, "20")
    try:
        got = {tuple(r) for r in W.session_aggregate(frame, "id", "ts", "10 seconds", **LEVELS).collect()}
    finally:
        spark.conf.set(name, before)
        spark.conf.unset(S.ROWS_PER_SLICE_CONF)
    want = set()
    for key in {r[0] for r in rows}:
        mine, held = sorted((s, v) for k, s, v in rows if k == key), []
        for s, v in mine:
            if held and s > held[-1][-1][0] + 10 or not held:
                held.append([])
            held[-1].append((s, v))
        for h in held:
            levels = [v for _, v in h]
            want.add((key, at(h[0][0]), at(h[-1][0] + 10), len(h), sum(levels) / len(levels), max(levels) - min(levels)))
    assert got == want
