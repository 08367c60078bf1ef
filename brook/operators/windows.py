"""Time, session and count windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brook.functions.durations import from_micros, interval, micros, to_micros
from brook.operators import scan as S
from brook.session import shared_dir


def windowed(df: DataFrame, keys: Sequence[str], ts: str, size: str, aggs: Sequence[Column],
             slide: str | None = None) -> DataFrame:
    """Aggregates per key and time window, with flat window bounds.

    Built-in aggregates keep one partial state per (key, window) and task, so
    neither a hot key nor a hot window travels row by row.
    """
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.groupBy(*keys, win.alias("_w")).agg(*aggs)
        .withColumn("window_start", F.col("_w.start"))
        .withColumn("window_end", F.col("_w.end")).drop("_w")
    )


def tumbling_count(df: DataFrame, key: str, ts: str = "ts", size: str = "5 seconds") -> DataFrame:
    return windowed(df, [key], ts, size, [F.count("*").alias("n")])


def sliding_count(df: DataFrame, key: str, ts: str = "ts", size: str = "50 seconds",
                  slide: str = "5 seconds") -> DataFrame:
    """Rows are counted once per pane of one slide; only the counts are spread over the windows that hold the pane."""
    if micros(size) % micros(slide):
        return windowed(df, [key], ts, size, [F.count("*").alias("n")], slide)
    panes = df.groupBy(key, F.window(ts, slide)["start"].alias("_pane")).agg(F.count("*").alias("_n"))
    back = F.explode(F.sequence(F.lit(0), F.lit(micros(size) // micros(slide) - 1))).alias("_back")
    return (
        panes.select(key, "_pane", "_n", back)
        .groupBy(key, (F.col("_pane") - F.col("_back") * interval(slide)).alias("window_start"))
        .agg(F.sum("_n").alias("n"))
        .select(key, "n", "window_start", (F.col("window_start") + interval(size)).alias("window_end"))
    )


def session_count(df: DataFrame, key: str, order: Sequence[str], gap: str = "5 seconds") -> DataFrame:
    """Rows per session; ``order`` starts with the event time.

    A session ends where the next row of the key is *more than* the gap away.
    Sessions are numbered by a running value, so a key whose rows form one
    endless session is counted in partial aggregates.
    """
    ts = order[0]
    rows = S.scan(df.select(key, *order), [key], order).add(_prev=S.previous(F.col(ts)))
    starts = F.col("_prev").isNull() | (F.col(ts) > F.col("_prev") + interval(gap))
    rows = rows.add(_session=S.total(F.when(starts, 1).otherwise(0).cast("bigint"))).rows()
    return (
        rows.groupBy(key, "_session")
        .agg(F.count("*").alias("n"), F.min(ts).alias("session_start"), F.max(ts).alias("_last"))
        .withColumn("session_end", F.col("_last") + interval(gap)).drop("_session", "_last")
    )


def count_window(df: DataFrame, key: str, order: Sequence[str], size: int = 5,
                 slide: int | None = None) -> DataFrame:
    """Count windows per key.

    Tumbling: one row per full window of ``size`` elements. Sliding: one row
    for every ``slide`` elements, counting the last ``size`` of them.
    """
    placed = S.scan(df.select(key, *order), [key], order).add(_pos=S.position()).rows()
    step = slide or size
    return placed.where(F.col("_pos") % step == 0).select(
        key,
        (F.col("_pos") / step).cast("bigint").alias("firing"),
        F.least(F.col("_pos"), F.lit(size)).cast("bigint").alias("n"),
    )


def window_average(df: DataFrame, key: str, value: str, ts: str = "ts", size: str = "15 seconds") -> DataFrame:
    return windowed(df, [key], ts, size, [F.avg(value).alias("avg")])


def window_minmax(df: DataFrame, key: str, value: str, ts: str = "ts", size: str = "10 seconds") -> DataFrame:
    """Minimum and maximum per window with its bounds; the true maximum, always."""
    return windowed(df, [key], ts, size, [
        F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max")])


def user_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    zero: Callable[[], tuple],
    add: Callable[[tuple, object], tuple],
    merge: Callable[[tuple, tuple], tuple],
    result: Callable[[tuple], tuple],
    accumulator: str,
    output: str,
) -> DataFrame:
    """An aggregate function of four methods over (key, window), in Python.

    For functions that no built-in aggregate expresses. Accumulators are built
    per Arrow batch before the exchange and merged one at a time after it, so a
    hot key travels as accumulators and no task ever holds a window's rows.
    ``accumulator`` and ``output`` are column lists such as ``"s double, n bigint"``.
    """
    group = [*keys, "window_start"]
    rows = df.withColumn("window_start", F.window(ts, size)["start"])
    named = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in group)
    fields = T.StructType.fromDDL(accumulator).fieldNames()
    outputs = T.StructType.fromDDL(output).fieldNames()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held: dict[tuple, tuple] = {}
            places = pdf[group].itertuples(index=False, name=None)
            for place, row in zip(places, pdf.itertuples(index=False, name="Record")):
                held[place] = add(held.get(place) or zero(), row)
            yield pd.DataFrame([(*k, *a) for k, a in held.items()], columns=[*group, *fields])

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, acc = None, None
        for pdf in batches:
            done = []
            for place in pdf.itertuples(index=False, name=None):
                key, part = tuple(place[: len(group)]), tuple(place[len(group):])
                if key == current:
                    acc = merge(acc, part)
                else:
                    if acc is not None:
                        done.append((*current, *result(acc)))
                    current, acc = key, part
            yield pd.DataFrame(done, columns=[*group, *outputs])
        if acc is not None:
            yield pd.DataFrame([(*current, *result(acc))], columns=[*group, *outputs])

    parts = rows.mapInPandas(partial, f"{named}, {accumulator}")
    return parts.repartition(*group).sortWithinPartitions(*group).mapInPandas(final, f"{named}, {output}")


def session_aggregate(
    df: DataFrame,
    key: str,
    ts: str,
    gap: str,
    zero: Callable[[], tuple],
    add: Callable[[tuple, object], tuple],
    merge: Callable[[tuple, tuple], tuple],
    result: Callable[[tuple], tuple],
    accumulator: str,
    output: str,
) -> DataFrame:
    """An aggregate function of four methods over sessions, in Python: (key, session_start, session_end, outputs).

    Sessions grow out of order: within an Arrow batch every row opens or joins a session, and one that closes the gap
    between two sessions merges them. These partial sessions travel as accumulators; those of one key that overlap or
    lie within the gap are numbered alike by running values, which cut hot keys, and merged in order of their start.
    """
    fields, outputs = T.StructType.fromDDL(accumulator).fieldNames(), T.StructType.fromDDL(output).fieldNames()
    wait = micros(gap)
    rows = df.withColumn("_at", to_micros(ts))
    kind = rows.schema[key].dataType.simpleString()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # One walk over the batch: a frame per key would cost far more than its few rows.
            places, names = pd.factorize(pdf[key], use_na_sentinel=False)
            kept: list[list[list]] = [[] for _ in range(len(names))]  # per key its disjoint sessions: first and last instant, accumulator
            for place, row in zip(places.tolist(), pdf.itertuples(index=False, name="Record")):
                held, at = kept[place], row[-1]
                near = [h for h in held[-8:] if h[0] - wait <= at <= h[1] + wait]
                if near:
                    near[0][0], near[0][1] = min(near[0][0], at), max(near[0][1], at)
                    near[0][2] = add(near[0][2], row)
                else:
                    held.append([at, at, add(zero(), row)])
            done = []
            for k, held in zip(names.tolist(), kept):
                held.sort(key=lambda h: h[0])
                grown = held[:1]
                for low, high, acc in held[1:]:
                    if low <= grown[-1][1] + wait:
                        grown[-1][1], grown[-1][2] = max(grown[-1][1], high), merge(grown[-1][2], acc)
                    else:
                        grown.append([low, high, acc])
                name = None if pd.isna(k) else k
                done += [(name, low, high, *acc) for low, high, acc in grown]
            yield pd.DataFrame(done, columns=[key, "_low", "_high", *fields])

    sessions = rows.mapInPandas(partial, f"`{key}` {kind}, _low bigint, _high bigint, {accumulator}")
    path = shared_dir(df.sparkSession, "sessions")
    sessions.write.parquet(path)
    sessions = df.sparkSession.read.schema(sessions.schema).parquet(path).withColumn(
        "_place", F.monotonically_increasing_id())
    numbered = S.scan(sessions, [key], ["_low", "_place"]).add(_top=S.highest(F.col("_high"), before=True))
    anew = F.col("_top").isNull() | (F.col("_low") > F.col("_top") + wait)
    numbered = numbered.add(_session=S.total(F.when(anew, 1).otherwise(0).cast("bigint"))).rows()
    group = [key, "_session"]

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, low, high, acc = None, 0, 0, None

        def closed():
            return (current[0], low, high, *result(acc))

        for pdf in batches:
            done = []
            for k, number, a, b, *part in pdf[[*group, "_low", "_high", *fields]].itertuples(index=False, name=None):
                if acc is not None and number == current[1] and (k == current[0] or (pd.isna(k) and pd.isna(current[0]))):
                    low, high, acc = min(low, a), max(high, b), merge(acc, tuple(part))
                else:
                    if acc is not None:
                        done.append(closed())
                    current, low, high, acc = (k, number), a, b, tuple(part)
            yield pd.DataFrame(done, columns=[key, "_low", "_high", *outputs])
        if acc is not None:
            yield pd.DataFrame([closed()], columns=[key, "_low", "_high", *outputs])

    merged = numbered.repartition(*group).sortWithinPartitions(*group, "_low", "_place").mapInPandas(
        final, f"`{key}` {kind}, _low bigint, _high bigint, {output}")
    return merged.select(key, from_micros("_low").alias("session_start"),
                         (from_micros("_high") + interval(gap)).alias("session_end"), *outputs)
