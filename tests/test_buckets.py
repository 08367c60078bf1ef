"""Processors that work on buckets of keys: as many calls and state rows as buckets, whatever the number of keys."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
import pytest
from feeds import at
from pyspark.sql import functions as F

from brook.operators import windows as W
from brook.plans.queries import LEVELS
from brook.streaming import chunks, run, state
from brook.streaming import processors as P

SCHEMA = "event_id bigint, id string, ts timestamp_ntz, vc int, arrival timestamp_ntz"


@pytest.fixture
def stream(spark, tmp_path):
    """600 keys, null among them, of six rows over three micro-batches; some readings are null."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    rows = [(i, f"k{i % 600}" if i % 600 else None, at(i), None if i % 7 == 0 else i * i % 50, at(i)) for i in range(3600)]
    frame = spark.createDataFrame(rows, SCHEMA)
    run.ordered_files(frame.repartition(3), ("arrival", "event_id"), f"{tmp_path}/feed")
    yield rows, run.event_feed(spark, f"{tmp_path}/feed", 4, frame.schema)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_running_values_by_buckets(spark, stream, tmp_path):
    rows, feed = stream
    out = chunks.last_values(feed)
    run.drain(out, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    want, last = [], {}
    for event_id, key, _, vc, _ in rows:
        want.append((event_id, key, vc, last.get(key, 0)))
        last[key] = last.get(key, 0) if vc is None else vc
    got = spark.read.schema(out.schema).parquet(f"{tmp_path}/out").select("event_id", "id", "vc", "last").collect()
    assert sorted(map(tuple, got)) == want
    assert state.read_state(spark, f"{tmp_path}/checkpoint", "known").count() <= chunks.BUCKETS  # a row per key before


def test_counts_by_buckets(spark, stream, tmp_path):
    _, feed = stream
    counts = P.bucket_counts(P.partial_counts(feed, "id"), "id", 16)
    run.drain_batches(counts, run.batch_table(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    got = run.latest_per_key(spark, f"{tmp_path}/out", ["key"]).collect()
    assert len(got) == 600 and {r.n for r in got} == {6} and None in {r.key for r in got}
    assert state.read_state(spark, f"{tmp_path}/checkpoint", "counts").count() <= 16


def test_partial_counts_join_batches_of_a_task(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10")
    try:
        rows = spark.range(1000).coalesce(1).select((F.col("id") % 5).cast("string").alias("w"))
        got = sorted(map(tuple, P.partial_counts(rows, "w").collect()))
    finally:
        spark.conf.set(name, before)
    assert got == [(str(i), 200) for i in range(5)]  # one row per key and Arrow batch before


def test_late_windows_by_buckets(spark, tmp_path):
    """Two windows of many keys fire at their end; late rows fire them again; too late ones give nothing."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    keys = [*(f"k{i}" for i in range(50)), None]
    batches = [[(k, 1) for k in keys] + [(k, 6) for k in keys], [("clock", 16)], [(k, 7) for k in keys] + [(k, 2) for k in keys]]

    def drain(rows):
        feed = run.event_feed(spark, f"{tmp_path}/feed/*", 100, rows.schema).withWatermark("ts", "2 seconds")
        fired = P.late_windows(P.window_counts(feed, "5 seconds"), 5000, 6000, 4)
        run.drain(fired, f"{tmp_path}/out", f"{tmp_path}/checkpoint")

    for i, batch in enumerate(batches):
        rows = spark.createDataFrame([(j, k, at(s), 0, at(j)) for j, (k, s) in enumerate(batch)], SCHEMA)
        rows.write.parquet(f"{tmp_path}/feed/{i}")
        drain(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = spark.read.parquet(f"{tmp_path}/out").groupBy("firing", "start_ms", "n").agg(F.count("*").alias("keys")).collect()
    assert sorted(map(tuple, got)) == [("first", 0, 1, 51), ("first", 5000, 1, 51), ("refire", 5000, 2, 51)]


def test_sessions_make_no_frame_per_key(spark, tmp_path, monkeypatch):
    """The first step walks a batch once; it grouped the batch into a frame per key before."""
    rows = [(f"k{i % 300}", at(i // 300 * 3), i % 9) for i in range(1500)]
    steps = []
    frame = spark.createDataFrame(rows, "id string, ts timestamp_ntz, vc int")
    kind = type(frame)
    plain = kind.mapInPandas
    monkeypatch.setattr(kind, "mapInPandas", lambda self, f, *a, **k: steps.append(f) or plain(self, f, *a, **k))
    got = W.session_aggregate(frame, "id", "ts", "5 seconds", **LEVELS).collect()
    assert len(got) == 300 and {r.n for r in got} == {5} and {r.session_end - r.session_start for r in got} == {timedelta(seconds=17)}
    grouped = []
    old = pd.DataFrame.groupby
    monkeypatch.setattr(pd.DataFrame, "groupby", lambda self, *a, **k: grouped.append(a) or old(self, *a, **k))
    batch = pd.DataFrame({"id": ["a", "b", None, "a"], "ts": 0, "vc": [1, 2, 3, 4], "_at": [0, 0, 0, 9_000_000]})
    assert [tuple(r[:3]) for r in next(steps[0](iter([batch]))).itertuples(index=False)] == [
        ("a", 0, 0), ("a", 9_000_000, 9_000_000), ("b", 0, 0), (None, 0, 0)]
    assert not grouped
