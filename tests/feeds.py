"""Constants and small frames that the tests share."""

from __future__ import annotations

from datetime import datetime, timedelta

SF = "/root/testdata/sf0.001"
EPOCH = datetime(1970, 1, 1)

# The eleven sensor readings of the fixture, in arrival order.
READINGS = [
    ("sensor_1", 1549044122, 10), ("sensor_1", 1549044123, 20), ("sensor_1", 1549044124, 30),
    ("sensor_2", 1549044125, 40), ("sensor_1", 1549044126, 50), ("sensor_2", 1549044127, 60),
    ("sensor_1", 1549044128, 70), ("sensor_3", 1549044129, 80), ("sensor_3", 1549044130, 90),
    ("sensor_3", 1549044131, 90), ("sensor_3", 1549054131, 90),
]
BASE = 1549000000


def at(seconds):
    return EPOCH + timedelta(seconds=seconds)


def clock(ts):
    """Seconds after the fixture's base time."""
    return int((ts - EPOCH).total_seconds()) - BASE


def sensor_frame(spark, rows):
    """(id, event second, level[, arrival second]) rows in arrival order."""
    made = [
        (i, r[0], at(r[1]), r[2], at(r[3] if len(r) > 3 else r[1])) for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(
        made, "event_id bigint, id string, ts timestamp_ntz, vc int, arrival timestamp_ntz")
