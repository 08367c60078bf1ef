"""Metrics as queries on the data, and observed metrics of a running query."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brook.functions.durations import from_micros, interval, micros
from brook.operators import scan as S
from brook.operators.rolling import prefixes
from brook.session import shared_dir

PIECE = 10_000  # idle steps listed at a time
SKETCH_SIZE = 1_000
GROUP = "MyGroup"  # fixed value: the metric group's name


def observed(df: DataFrame, group: str = GROUP, **metrics: Column) -> DataFrame:
    """Attach metrics to a frame; read them from an Observation or query progress."""
    return df.observe(group, *[c.alias(n) for n, c in metrics.items()])


def counter(df: DataFrame, name: str, step: int = 1, group: str = GROUP) -> DataFrame:
    """Final reading of a counter that adds ``step`` per row."""
    total = F.coalesce(F.sum(F.lit(step).cast("bigint")), F.lit(0)).alias("value")
    return df.agg(total).select(F.lit(group).alias("metric_group"), F.lit(name).alias("metric"), "value")


def histogram_last(df: DataFrame, value: str, order: Sequence[str], n: int = 1000) -> DataFrame:
    """Statistics of the last ``n`` values by arrival: a top-k, not a full sort."""
    last = df.select(value, *order).orderBy(*[F.desc(c) for c in order]).limit(n)
    quantiles = {"median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    return last.agg(
        F.count("*").alias("n"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.round(F.avg(value), 6).alias("mean"),
        F.round(F.stddev_samp(value), 6).alias("stddev"),
        *[F.round(F.percentile(value, q), 6).alias(name) for name, q in quantiles.items()],
    )


def meter_rate(df: DataFrame, ts: str = "ts", span: str = "60 seconds") -> DataFrame:
    """Events per second in each window of ``span``."""
    seconds = micros(span) / 1_000_000
    return df.groupBy(F.window(ts, span)["start"].alias("window_start")).agg(
        F.count("*").alias("n"), (F.count("*") / F.lit(seconds)).alias("rate"))


def trailing_rates(df: DataFrame, ts: str = "ts", step: str = "1 minute",
                   spans: Sequence[int] = (1, 5, 15)) -> DataFrame:
    """Events per step over the last 1, 5 and 15 steps, at every step that saw events.

    Counts per step are spread over the steps they still count for and summed,
    so no window runs over the whole table.
    """
    per_step = df.groupBy(F.window(ts, step)["start"].alias("at")).agg(F.count("*").alias("n"))
    spread = per_step.select("at", "n", F.explode(F.sequence(F.lit(0), F.lit(max(spans) - 1))).alias("age"))
    sums = [
        F.sum(F.when(F.col("age") < k, F.col("n")).otherwise(0)).alias(f"_sum_{k}") for k in spans
    ]
    out = spread.groupBy((F.col("at") + F.col("age") * interval(step)).alias("step_start")).agg(
        *sums, F.min("age").alias("_age"))
    return out.where(F.col("_age") == 0).select(
        "step_start", *[(F.col(f"_sum_{k}") / F.lit(float(k))).alias(f"rate_{k}") for k in spans])


def exponential_rates(df: DataFrame, ts: str = "ts", step: str = "1 minute",
                      spans: Sequence[int] = (1, 5, 15)) -> DataFrame:
    """Exponentially weighted events per step over 1, 5 and 15 steps, at every step from the first to the last.

    Each step moves a rate by ``1 - exp(-1 / span)`` of the way to that step's count; the first step sets it. So a run of
    steps maps a rate affinely: it decays by the steps' time and what the run itself adds comes on top. Such maps
    compose: slices of steps are folded on their own, what enters a slice is the composition of those before it, and a
    gap of any length is one power. Steps without events are listed from the event step before them, in pieces of
    ``PIECE``, so that no task holds all of them.
    """
    unit = micros(step)
    per_step = df.where(F.col(ts).isNotNull()).groupBy(F.window(ts, step)["start"].alias("at")).agg(F.count("*").alias("n"))
    per_step = per_step.withColumn("t", F.expr(f"unix_micros(cast(at as timestamp)) div {unit}L"))
    path = shared_dir(df.sparkSession, "steps")
    per_step.write.parquet(path)
    per_step = df.sparkSession.read.schema(per_step.schema).parquet(path)
    first = per_step.agg(F.min("t")).first()[0]
    laid = S.scan(per_step, [], ["t"])
    # A step's own weight; the very first one counts in full.
    moved = laid.df.select(S.SLICE, "t", *[
        (F.col("n") * F.when(F.col("t") == F.lit(first), 1.0).otherwise(1.0 - math.exp(-1.0 / k))).alias(f"r{k}") for k in spans])
    names = [f"r{k}" for k in spans]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last, held = None, 0, [0.0] * len(spans)
        for batch in batches:
            out = [[] for _ in spans]
            columns = [batch.column(c).to_pylist() for c in (S.SLICE, "t", *names)]
            for place, t, *own in zip(*columns):
                if place != current:
                    current, held = place, own
                else:
                    held = [h * math.exp((last - t) / k) + x for h, x, k in zip(held, own, spans)]
                last = t
                for o, h in zip(out, held):
                    o.append(h)
            yield pa.RecordBatch.from_arrays(
                [batch.column(S.SLICE), batch.column("t"), *[pa.array(o, pa.float64()) for o in out]], names=[S.SLICE, "t", *names])

    local = moved.repartition(S.SLICE).sortWithinPartitions(S.SLICE, "t").mapInArrow(
        fold, f"`{S.SLICE}` bigint, t bigint, " + ", ".join(f"{c} double" for c in names))
    path = shared_dir(df.sparkSession, "rates")
    local.write.parquet(path)
    local = df.sparkSession.read.schema(local.schema).parquet(path).withColumn(S.HOT, F.lit(0).cast("bigint"))

    def then(a: Column, b: Column) -> Column:
        """Two runs one after the other: the first one's rates decay over the second one's time."""
        return F.struct(b["t"].alias("t"), *[
            (b[c] + a[c] * F.exp((a["t"] - b["t"]) / F.lit(float(k)))).alias(c) for c, k in zip(names, spans)])

    ends = local.groupBy(S.HOT, S.SLICE).agg(F.max_by(F.struct("t", *names), "t").alias("_before"))
    before = prefixes(ends, "_before", then)
    rates = laid.with_carry(local, before).select("t", *[
        (F.col(c) + F.coalesce(F.col("_before")[c] * F.exp((F.col("_before")["t"] - F.col("t")) / F.lit(float(k))), F.lit(0.0))).alias(c)
        for c, k in zip(names, spans)])
    # Idle steps belong to the event step before them.
    gaps = S.scan(rates, [], ["t"], profile=per_step).add(nxt=S.following(F.col("t"))).rows()
    upto = F.coalesce(F.col("nxt") - 1, F.col("t"))
    pieces = gaps.select("t", *names, upto.alias("upto"), F.explode(F.sequence(F.col("t"), upto, F.lit(PIECE))).alias("low"))
    wide = pieces.where(F.col("upto") - F.col("t") >= PIECE).repartition("low")
    listed = pieces.where(F.col("upto") - F.col("t") < PIECE).unionAll(wide).select(
        "t", *names, F.explode(F.sequence("low", F.least("upto", F.col("low") + F.lit(PIECE - 1)))).alias("s"))
    return listed.select(
        from_micros(F.col("s") * unit).alias("step_start"),
        *[F.round(F.col(c) * F.exp((F.col("t") - F.col("s")) / F.lit(float(k))), 6).alias(f"rate_{k}") for c, k in zip(names, spans)])


def delay_sketches(df: DataFrame, ts: str = "ts", arrival: str = "arrival", pane: str = "5 seconds",
                   k: int = SKETCH_SIZE) -> DataFrame:
    """A quantile sketch of the delays of each pane; its size is bounded whatever the number of rows.

    For ``k`` = 1,000 the rank of an answer is off by less than 0.5 % of the rows with 99 % confidence.
    """
    return df.groupBy(F.window(ts, pane)["start"].alias("pane_start")).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_bigint(_delay(ts, arrival), F.lit(k)).alias("sketch"))


def merged_delays(sketches: DataFrame, size: str, shares: Sequence[float] = (0.5, 0.95), k: int = SKETCH_SIZE) -> DataFrame:
    """Quantiles over longer windows, from the panes' sketches: rows are not read again."""
    names = [f"p{round(100 * s)}_delay" for s in shares]
    merged = sketches.groupBy(F.window("pane_start", size)["start"].alias("window_start")).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))
    return merged.select("window_start", "n", *[
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(s)).alias(c) for s, c in zip(shares, names)])


def rank_errors(df: DataFrame, quantiles: DataFrame, size: str, shares: Sequence[float] = (0.5, 0.95), ts: str = "ts",
                arrival: str = "arrival") -> DataFrame:
    """How far the rank of each quantile is from what was asked, as a share of its window's rows: 0 where it is exact."""
    names = [f"p{round(100 * s)}_delay" for s in shares]
    counts = df.groupBy(F.window(ts, size)["start"].alias("window_start"), _delay(ts, arrival).alias("_d")).agg(
        F.count("*").alias("_k"))
    both = counts.join(quantiles, "window_start")
    under = [F.sum(F.when(F.col("_d") < F.col(c), F.col("_k")).otherwise(0)).alias(f"_u_{c}") for c in names]
    upto = [F.sum(F.when(F.col("_d") <= F.col(c), F.col("_k")).otherwise(0)).alias(f"_t_{c}") for c in names]
    ranks = both.groupBy("window_start", "n").agg(*under, *upto)
    return ranks.select("window_start", "n", *[
        F.greatest(F.col(f"_u_{c}") / F.col("n") - s, s - F.col(f"_t_{c}") / F.col("n"), F.lit(0.0)).alias(f"{c[:-6]}_error")
        for c, s in zip(names, shares)])


def _delay(ts: str, arrival: str) -> Column:
    return F.unix_seconds(F.col(arrival).cast("timestamp")) - F.unix_seconds(F.col(ts).cast("timestamp"))


def delay_stats(df: DataFrame, ts: str = "ts", arrival: str = "arrival", size: str = "5 seconds",
                accuracy: int | None = None) -> DataFrame:
    """Delay from event time to arrival, in seconds, per event-time window.

    Exact percentiles keep one count per different delay, in partial aggregates. Where delays have no bound, pass an
    ``accuracy``: the percentiles then come from a sketch of bounded size whose rank error is 1 / accuracy.
    """
    def share(p: float):
        return F.percentile("_d", p) if accuracy is None else F.percentile_approx("_d", p, accuracy)

    return df.withColumn("_d", _delay(ts, arrival)).groupBy(F.window(ts, size)["start"].alias("window_start")).agg(
        F.count("*").alias("n"),
        F.max("_d").alias("max_delay"),
        F.round(F.avg("_d"), 6).alias("avg_delay"),
        F.round(share(0.5), 6).alias("p50_delay"),
        F.round(share(0.95), 6).alias("p95_delay"),
    )
