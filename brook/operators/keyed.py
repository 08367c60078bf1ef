"""Keyed state in bounded form: previous values, expiry, jump alerts, timers.

What needs only earlier rows of the key is a running value (see ``scan``). The
single-timer machines read one row per key and clock reading, all that they can
tell apart (see ``timers``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brook.functions.durations import interval, micros, to_micros
from brook.operators import machines as M
from brook.operators import scan as S
from brook.operators import timers
from brook.operators.eventtime import TICK, with_watermark

ARRIVAL = ("arrival", "event_id")


def process_element(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Each record with its key and its own time, as a process function sees it."""
    return df.select(F.col(key).alias("key"), F.col(ts).alias("record_ts"), "event_id", "vc")


def last_value(df: DataFrame, key: str, value: str, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The previous value of the key; 0 on its first row."""
    rows = S.scan(df, [key], order).add(_last=S.previous(F.col(value))).rows()
    return rows.withColumn("last", F.coalesce("_last", F.lit(0))).drop("_last")


def last_value_global(df: DataFrame, value: str, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The previous value of *any* key: what one unkeyed field would hold."""
    rows = S.scan(df, [], order).add(_last=S.previous(F.col(value))).rows()
    return rows.withColumn("last", F.coalesce("_last", F.lit(0))).drop("_last")


def ttl_count(df: DataFrame, key: str, order: Sequence[str], ttl: str = "10 seconds") -> DataFrame:
    """Running count per key that starts anew after ``ttl`` without a row."""
    clock = F.col(order[0])
    rows = S.scan(df, [key], order).add(_prev=S.previous(clock), _pos=S.position())
    anew = F.col("_prev").isNull() | (clock >= F.col("_prev") + interval(ttl))
    rows = rows.add(_start=S.highest(F.when(anew, F.col("_pos")))).rows()
    return rows.withColumn("n", F.col("_pos") - F.col("_start") + 1).drop("_prev", "_pos", "_start")


def jump_alert(df: DataFrame, threshold: float = 1.7, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Readings further than ``threshold`` from the previous one, which starts at 0."""
    diff = F.abs(F.col("vc") - F.col("last"))
    return last_value(df, "id", "vc", order).where(diff > threshold).select(
        "event_id", "id", "vc", diff.alias("diff"))


def jump_alert_self_cleaning(df: DataFrame, threshold: int = 10, keep: str = "60 seconds",
                             bound: str = "2 seconds", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Jump alert that forgets the previous value once its timer has fired.

    Every reading sets the timer to its own event time + ``keep``; the watermark
    fires it. A timer behind the watermark fires when the watermark moves next.
    """
    rows = with_watermark(df, order, "ts", bound)
    before = F.struct("vc", (F.col("ts") + interval(keep)).alias("timer"), "wm_before")
    rows = S.scan(rows, ["id"], order, profile=df).add(_p=S.previous(before)).rows()
    wm, p = F.col("wm_before"), F.col("_p")
    cleaned = (wm >= p["timer"]) & (p["wm_before"].isNull() | (wm > p["wm_before"]))
    last = F.when(p.isNull() | F.coalesce(cleaned, F.lit(False)), 0).otherwise(p["vc"])
    diff = F.abs(F.col("vc") - last)
    return rows.where(diff > threshold).select("event_id", "id", "vc", diff.alias("diff"))


def timer_per_event(df: DataFrame, delay: str = "5 seconds", bound: str = "2 seconds",
                    order: Sequence[str] = ARRIVAL) -> DataFrame:
    """An event-time timer per record: (id, fire time, watermark that fires it).

    Equal timers of a key are one timer. The watermark that fires a timer is the
    least one reached at or after it, found by one ordered pass over timers and
    watermarks together; timers beyond the last watermark stay open.
    """
    rows = with_watermark(df.select("id", "ts", *order), order, "ts", bound, keep_after=True)
    timer = F.col("ts") + interval(delay)
    due = F.greatest(timer, F.col("wm_before") + interval(TICK))
    # Timers and watermarks come from one pass over the rows, each taken once.
    both = rows.select(F.inline(F.array(
        F.struct("id", timer.alias("fire_time"), due.alias("at"), F.lit(0).alias("rank")),
        F.struct(
            F.lit(None).cast("string").alias("id"), F.lit(None).cast("timestamp_ntz").alias("fire_time"),
            F.col("watermark").alias("at"), F.lit(1).alias("rank")),
    ))).distinct()
    # Timers lie `delay` after event times: those serve as the profile to cut on.
    found = S.scan(both, [], ["at", "rank", "id", "fire_time"],
                   profile=df.select(timer.alias("at"), F.lit(0).alias("rank"), "id", timer.alias("fire_time"))).add(
        watermark=S.next_known(F.when(F.col("rank") == 1, F.col("at")))).rows()
    return found.where((F.col("rank") == 0) & F.col("watermark").isNotNull()).select(
        "id", "fire_time", "watermark").distinct()


def timer_processing(df: DataFrame, delay: str = "5 seconds", clock: str = "arrival") -> DataFrame:
    """A timer per record on the arrival clock; ``fired`` once the feed got that far."""
    end = df.agg(F.max(to_micros(clock))).first()[0]
    timers = df.select("id", (F.col(clock) + interval(delay)).alias("fire_time")).distinct()
    return timers.withColumn("fired", to_micros("fire_time") <= F.lit(end))


# -- single-timer machines -----------------------------------------------------

def _event_clock(df: DataFrame, bound: str, order: Sequence[str]) -> tuple[DataFrame, int | None]:
    """Rows with the watermark they meet as a number, and their place ``pos`` in the feed; the last watermark.

    A place that is one number keeps the first-and-last aggregates hash-based.
    """
    scan = S.scan(df, [], order, facts={"top": F.max(to_micros("ts"))})
    rows = scan.add(_top=S.highest(F.col("ts"), before=True), pos=S.position()).rows()
    clock = F.coalesce(to_micros("_top") - F.lit(micros(bound)), F.lit(M.LONG_AGO))
    top = scan.facts["top"]
    return (rows.withColumns({"clock": clock, "base": to_micros("ts")}).drop("_top"),
            None if top is None else top - micros(bound))


def _end(df: DataFrame, clock: str) -> int | None:
    return df.agg(F.max(to_micros(clock))).first()[0]


def _no_break() -> Column:
    return F.lit(False).alias("breaks")


def timer_one_per_key(df: DataFrame, delay: str = "5 seconds", bound: str = "2 seconds",
                      order: Sequence[str] = ARRIVAL, keep_open: bool = False) -> DataFrame:
    """At most one pending event-time timer per key; the next row after it fired sets anew."""
    rows, end = _event_clock(df.select("id", "ts", *order), bound, order)
    first = rows.groupBy("id", "clock").agg(F.min_by("base", "pos").alias("base"))
    ticks = first.select("id", "clock", (F.col("base") + micros(delay)).alias("sets"), _no_break())
    return timers.fold(ticks, end, keep_open, df.select("id"))


def timer_one_per_key_processing(df: DataFrame, delay: str = "5 seconds",
                                 keep_open: bool = False) -> DataFrame:
    """The same on the arrival clock."""
    clock = to_micros("arrival").alias("clock")
    ticks = df.select("id", clock).distinct().select("id", "clock", (F.col("clock") + micros(delay)).alias("sets"), _no_break())
    return timers.fold(ticks, _end(df, "arrival"), keep_open, df.select("id", clock))


def rising_alert_event(df: DataFrame, hold: str = "5 seconds", bound: str = "2 seconds",
                       order: Sequence[str] = ARRIVAL, keep_open: bool = False) -> DataFrame:
    """Alert when a level has kept rising for ``hold`` of event time.

    The first row sets a timer; a row that did not rise drops it and sets one from its own time.
    """
    rows, end = _event_clock(df.select("id", "ts", "vc", *order), bound, order)
    rows = S.scan(rows, ["id"], order, profile=df).add(_prev=S.previous(F.col("vc"))).rows()
    not_risen = F.when(F.col("vc") <= F.col("_prev"), F.col("pos"))
    ticks = rows.groupBy("id", "clock").agg(
        F.min_by("base", "pos").alias("base"), F.max_by("base", not_risen).alias("reset"))
    ticks = ticks.select("id", "clock", (F.coalesce("reset", "base") + micros(hold)).alias("sets"),
                         F.col("reset").isNotNull().alias("breaks"))
    return timers.fold(ticks, end, keep_open, df.select("id"))


def rising_alert_processing(df: DataFrame, hold: str = "10 seconds", order: Sequence[str] = ARRIVAL,
                            keep_open: bool = False) -> DataFrame:
    """Alert when a level has not fallen for ``hold`` of the arrival clock after a rise.

    A previous value of 0 stands for "no reading yet" and is passed over. A fall drops the timer, a rise sets one.
    """
    rows = S.scan(df.select("id", "vc", *order), ["id"], order).add(
        _last=S.previous(F.col("vc")), pos=S.position()).rows()
    last = F.coalesce("_last", F.lit(0))
    rose = F.when((last != 0) & (F.col("vc") > last), F.col("pos"))
    fell = F.when((last != 0) & (F.col("vc") < last), F.col("pos"))
    ticks = rows.groupBy("id", to_micros("arrival").alias("clock")).agg(
        F.max(rose).alias("_rose"), F.max(fell).alias("_fell"))
    # A tick that fell ends with a timer only if it rose after that.
    sets = F.when(F.col("_fell").isNull() | (F.col("_rose") > F.col("_fell")), F.col("clock") + micros(hold))
    ticks = ticks.where("_rose is not null or _fell is not null").select(
        "id", "clock", sets.alias("sets"), F.col("_fell").isNotNull().alias("breaks"))
    return timers.fold(ticks, _end(df, "arrival"), keep_open, df.select("id", to_micros("arrival").alias("clock")))
