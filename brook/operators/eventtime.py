"""Event time: watermarks per record and the three policies for late rows.

The watermark before a row is the greatest event time of all earlier arrivals
minus a bound. It is a running maximum over the whole feed, so it is computed
slice by slice (see ``scan``), never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.durations import from_micros, interval, micros, to_micros
from brook.operators import scan as S

TICK = "1 millisecond"  # a window's last instant is its end minus one tick


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def marked(df: DataFrame, order: Sequence[str], ts: str = "ts", bound: str = "2 seconds",
           keep_after: bool = False) -> tuple[DataFrame, int | None]:
    """Rows with ``wm_before`` (and ``watermark``), and the greatest event time in microseconds, from one eager pass."""
    top = {"wm_before": S.highest(F.col(ts), before=True)}
    if keep_after:
        top["watermark"] = S.highest(F.col(ts))
    scan = S.scan(df, [], order, facts={"top": F.max(to_micros(ts))})
    out = scan.add(**top).rows()
    return out.withColumns({c: F.col(c) - interval(bound) for c in top}), scan.facts["top"]


def with_watermark(df: DataFrame, order: Sequence[str], ts: str = "ts", bound: str = "2 seconds",
                   keep_after: bool = False) -> DataFrame:
    """Append ``wm_before``, and with ``keep_after`` also ``watermark``.

    ``wm_before`` is the watermark in force when the row is processed, null
    before any has been seen; ``watermark`` is the one right after the row.
    """
    return marked(df, order, ts, bound, keep_after)[0]


def final_watermark(top: int | None, bound: str = "2 seconds"):
    """The watermark after the last row, as a literal column, from the greatest event time."""
    return from_micros(F.lit(None if top is None else top - micros(bound)).cast("bigint"))


def watermark_per_record(df: DataFrame, order: Sequence[str], ts: str = "ts",
                         bound: str = "2 seconds") -> DataFrame:
    """Watermark after every record; it never moves back and starts at 1970."""
    out = S.scan(df, [], order).add(_top=S.highest(F.col(ts))).rows()
    return out.withColumn("watermark", F.greatest(F.col("_top") - interval(bound), _epoch())).drop("_top")


def watermark_per_block(df: DataFrame, arrival: str, ts: str = "ts", every: str = "10 seconds",
                        bound: str = "2 seconds") -> DataFrame:
    """Watermark emitted at the end of each arrival block that holds rows."""
    blocks = df.groupBy(F.window(arrival, every)["start"].alias("block_start")).agg(
        F.max(ts).alias("_top"))
    return watermark_per_record(blocks, ["block_start"], "_top", bound).drop("_top")


def watermark_min_over_inputs(df: DataFrame, source: str, sources: Sequence, order: Sequence[str],
                              ts: str = "ts", bound: str = "2 seconds") -> DataFrame:
    """With several inputs the watermark is that of the slowest one.

    Null until every input has delivered a row.
    """
    tops = {
        f"_top{i}": S.highest(F.when(F.col(source) == F.lit(v), F.col(ts)))
        for i, v in enumerate(sources)
    }
    out = S.scan(df, [], order).add(**tops).rows()
    known = F.lit(True)
    for c in tops:
        known = known & F.col(c).isNotNull()
    slowest = F.least(*[F.col(c) for c in tops]) if len(tops) > 1 else F.col("_top0")
    return out.withColumn("watermark", F.when(known, slowest - interval(bound))).drop(*tops)


def classify(df: DataFrame, order: Sequence[str], ts: str = "ts", size: str = "5 seconds",
             bound: str = "2 seconds", lateness: str = "0 seconds") -> DataFrame:
    """Append window bounds and the class of each row.

    ``on_time``: its window has not fired yet. ``refire``: it has, but is still
    kept for the allowed lateness. ``late``: it is gone.
    """
    return _classified(df, order, ts, size, bound, lateness)[0]


def _classified(df, order, ts, size, bound, lateness) -> tuple[DataFrame, int | None]:
    rows, top = marked(df, order, ts, bound)
    win = F.window(ts, size)
    last = F.col("window_end") - interval(TICK)
    wm = F.col("wm_before")
    return rows.withColumn("_w", win).withColumn("window_start", F.col("_w.start")).withColumn(
        "window_end", F.col("_w.end")).drop("_w").withColumn(
        "row_class",
        F.when(wm.isNull() | (wm < last), "on_time")
        .when(wm < last + interval(lateness), "refire").otherwise("late")), top


def _fired(top: int | None, bound: str, flush: bool):
    """Windows that fired by the end of the feed; all of them when flushing."""
    if flush:
        return F.lit(True)
    return F.col("window_end") - interval(TICK) <= final_watermark(top, bound)


def late_drop(df: DataFrame, key: str, order: Sequence[str], ts: str = "ts", size: str = "5 seconds",
              bound: str = "2 seconds", flush: bool = False) -> DataFrame:
    """Window counts without late rows. ``flush`` also closes the last windows."""
    rows, top = _classified(df, order, ts, size, bound, "0 seconds")
    rows = rows.where(F.col("row_class") == "on_time")
    return rows.groupBy(key, "window_start", "window_end").agg(F.count("*").alias("n")).where(
        _fired(top, bound, flush))


def late_refire(df: DataFrame, key: str, order: Sequence[str], ts: str = "ts", size: str = "5 seconds",
                bound: str = "2 seconds", lateness: str = "2 seconds", flush: bool = False) -> DataFrame:
    """Every firing: the first one of a window, then one per row within the lateness."""
    rows, top = _classified(df, order, ts, size, bound, lateness)
    kept = rows.where(F.col("row_class") != "late")
    # One ordered pass per window: its last row in time is the first firing.
    placed = S.scan(
        kept, [key, "window_start"], order,
        profile=df.select(key, *order, F.window(ts, size)["start"].alias("window_start")),
    ).add(n=S.position(), _next=S.following(F.col("row_class"))).rows()
    is_first = (
        (F.col("row_class") == "on_time")
        & (F.col("_next").isNull() | (F.col("_next") == "refire")) & _fired(top, bound, flush))
    return placed.where(is_first | (F.col("row_class") == "refire")).select(
        key, "window_start", "window_end",
        F.when(F.col("row_class") == "on_time", "first").otherwise("refire").alias("firing"), "n")


def late_rows(df: DataFrame, order: Sequence[str], ts: str = "ts", size: str = "5 seconds",
              bound: str = "2 seconds", lateness: str = "2 seconds") -> DataFrame:
    """Raw rows that came too late even for the allowed lateness."""
    out = classify(df, order, ts, size, bound, lateness).where(F.col("row_class") == "late")
    return out.select(*df.columns)
