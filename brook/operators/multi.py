"""Operators over several inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brook.operators import scan as S


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of same-typed inputs, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def connect(left: DataFrame, right: DataFrame, left_map: Column, right_map: Column,
            name: str = "value") -> DataFrame:
    """Two differently typed inputs, each mapped to one common column."""
    return left.select(left_map.alias(name)).unionAll(right.select(right_map.alias(name)))


def side_output(df: DataFrame, condition: Column, text: Column) -> tuple[DataFrame, DataFrame]:
    """All rows on the main output; rows that meet ``condition`` also as text."""
    return df, df.where(condition).select(text.alias("alarm"))


def gate_forward(readings: DataFrame, switches: DataFrame, extend: bool = False) -> DataFrame:
    """Readings (event_id, id, vc, arrival) that pass their key's gate.

    A switch (event_id, id, duration_ms, arrival) opens the gate. Every switch
    sets its own expiry and the earliest pending one closes the gate; with
    ``extend`` the gate stays open until the latest expiry instead. At equal
    times an expiry comes before a switch and a switch before a reading.
    """
    ends = F.col("arrival") + F.make_dt_interval(secs=F.col("duration_ms") / 1000)
    columns = ["id", "arrival", "rank", "event_id", "vc", "expiry"]
    no_vc, no_end = F.lit(None).cast("int"), F.lit(None).cast("timestamp_ntz")
    opened = switches.withColumns({"rank": F.lit(1), "vc": no_vc, "expiry": ends}).select(columns)
    closed = switches.withColumns({"arrival": ends, "rank": F.lit(0), "vc": no_vc, "expiry": no_end})
    shown = readings.withColumns({"rank": F.lit(2), "expiry": no_end}).select(columns)
    tagged = union_all(opened, closed.select(columns), shown)

    is_rank = lambda r: F.when(F.col("rank") == r, F.col("arrival"))
    rows = S.scan(tagged, ["id"], ["arrival", "rank", "event_id"]).add(
        _opened=S.highest(is_rank(1)), _closed=S.highest(is_rank(0)), _until=S.highest(F.col("expiry"))
    ).rows()
    if extend:
        is_open = F.col("_until") > F.col("arrival")
    else:
        is_open = F.col("_opened").isNotNull() & (
            F.col("_closed").isNull() | (F.col("_opened") >= F.col("_closed")))
    return rows.where((F.col("rank") == 2) & is_open).select("event_id", "id", "vc", "arrival")


def dynamic_threshold_alert(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """Readings whose jump exceeds the threshold in force for their sensor.

    Rules (event_id, id, threshold_vc, arrival) and readings share the arrival
    clock; at equal times the rule comes first. Threshold 0 removes a rule. The
    previous value starts at 0 and moves even while no rule is set.
    """
    columns = ["id", "arrival", "rank", "event_id", "vc", "threshold_vc"]
    nothing = F.lit(None).cast("int")
    tagged = union_all(
        rules.withColumns({"rank": F.lit(0), "vc": nothing}).select(columns),
        readings.withColumns({"rank": F.lit(1), "threshold_vc": nothing}).select(columns),
    )
    return threshold_alerts(tagged)


def threshold_alerts(tagged: DataFrame) -> DataFrame:
    """The same on rules (rank 0) and readings (rank 1) in one frame."""
    rows = S.scan(tagged, ["id"], ["arrival", "rank", "event_id"]).add(
        _rule=S.latest(F.col("threshold_vc")), _prev=S.latest(F.col("vc"), before=True)).rows()
    diff = F.abs(F.col("vc") - F.coalesce("_prev", F.lit(0)))
    return rows.where((F.col("rank") == 1) & (F.col("_rule") != 0) & (diff > F.col("_rule"))).select(
        "event_id", "id", "vc", diff.alias("diff"))


def static_threshold_alert(jumps: DataFrame, rules: DataFrame) -> DataFrame:
    """Jumps (id, vc, diff) over a fixed rule table (id, threshold_vc); the engine broadcasts the table if it is small."""
    return jumps.join(rules, "id").where(
        (F.col("threshold_vc") != 0) & (F.col("diff") > F.col("threshold_vc"))).select("id", "vc", "diff")
