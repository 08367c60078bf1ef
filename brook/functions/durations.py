"""Durations written as text, such as ``"5 seconds"`` or ``"2 hours"``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(duration: str) -> int:
    """The length of a duration in microseconds."""
    amount, unit = duration.split()
    return int(amount) * _UNIT_MICROS[unit.lower().rstrip("s")]


def interval(duration: str) -> Column:
    """The duration as a day-time interval column."""
    return (F.lit(micros(duration)) * F.expr("INTERVAL '0.000001' SECOND")).cast(
        "interval day to second"
    )


def to_micros(ts: Column | str) -> Column:
    """A timestamp (with or without zone) as microseconds since 1970."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column | str) -> Column:
    """Microseconds since 1970 as a zone-less timestamp."""
    us = F.col(us) if isinstance(us, str) else us
    return F.timestamp_micros(us).cast("timestamp_ntz")


def from_seconds(s: Column | str) -> Column:
    """Seconds since 1970, as text files carry them, as a zone-less timestamp."""
    s = F.col(s) if isinstance(s, str) else s
    return F.timestamp_seconds(s).cast("timestamp_ntz")
