"""Streaming aggregates and windows. Partial aggregates run before the exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.durations import micros
from brook.operators.rolling import tokenize


def word_count(lines: DataFrame) -> DataFrame:
    """Running word counts; use update mode."""
    return tokenize(lines).groupBy("word").agg(F.sum("one").alias("n"))


def running_count(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def unique_visitors(rows: DataFrame, member: str = "user_id") -> DataFrame:
    """Running number of different members; use complete mode.

    Members are remembered for as long as the query lives.
    """
    return rows.select(member).dropDuplicates([member]).groupBy().agg(F.count("*").alias("uv"))


def _flat(rows: DataFrame, window: str) -> DataFrame:
    return rows.withColumns({
        f"{window}_start": F.col("_w.start"), f"{window}_end": F.col("_w.end")}).drop("_w")


def tumbling_count(rows: DataFrame, key: str, size: str, bound: str, slide: str | None = None) -> DataFrame:
    """Counts per key and window; rows behind the watermark are dropped."""
    win = F.window("ts", size, slide) if slide else F.window("ts", size)
    return _flat(
        rows.withWatermark("ts", bound).groupBy(key, win.alias("_w")).agg(F.count("*").alias("n")), "window")


def session_count(rows: DataFrame, key: str, gap: str, bound: str) -> DataFrame:
    return _flat(
        rows.withWatermark("ts", bound).groupBy(key, F.session_window("ts", gap).alias("_w"))
        .agg(F.count("*").alias("n")), "session")


def refiring_count(rows: DataFrame, key: str, size: str, bound: str, lateness: str) -> DataFrame:
    """Window counts that keep taking late rows for ``lateness``; use update mode.

    The watermark is held back by the lateness, so a window's count is sent
    again after every batch that changes it.
    """
    held = f"{(micros(bound) + micros(lateness)) // 1000} milliseconds"
    return tumbling_count(rows, key, size, held)
