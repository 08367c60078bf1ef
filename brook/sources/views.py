"""Event-analytics views over the stored tables.

``events`` stands in for live feeds. Sensor clocks are whole seconds, as the
text feeds carry them. ``arrival`` is a disordered processing clock: each event
arrives up to six hours after its event time, so every class of late row occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.functions.durations import from_seconds

PAGE_VIEW = "view"  # plays the role of the page-view behaviour

# The four marketing channels, in table order.
CHANNELS = ("XIAOMI", "HUAWEI", "OPPO", "VIVO")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _k(props: str = "props"):
    return F.get_json_object(props, "$.k").cast("int")


def as_behaviors(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        F.col("event_id").alias("item_id"),
        _k().alias("category_id"),
        F.col("event_type").alias("behavior"),
        "ts",
    )


def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, item_id, category_id, behavior, ts."""
    return as_behaviors(events(spark, sf_dir))


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviors(spark, sf_dir).where(F.col("behavior") == PAGE_VIEW)


def as_sensors(events: DataFrame) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    delay = (F.col("event_id") * 7919) % 21601
    return events.select(
        "event_id",
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        from_seconds(seconds).alias("ts"),
        F.floor("value").cast("int").alias("vc"),
        from_seconds(seconds + delay).alias("arrival"),
        "event_type",
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, id, ts, vc, arrival."""
    return as_sensors(events(spark, sf_dir)).drop("event_type")


def marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, behavior, channel, ts."""
    names = F.array(*[F.lit(c) for c in CHANNELS])
    return events(spark, sf_dir).select(
        "event_id",
        "user_id",
        F.col("event_type").alias("behavior"),
        F.element_at(names, _k() % len(CHANNELS) + 1).alias("channel"),
        "ts",
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold rules from sign-ups; threshold 0 removes a rule."""
    rows = as_sensors(events(spark, sf_dir)).where(F.col("event_type") == "signup")
    return rows.select("event_id", "id", (F.col("vc") % 40).alias("threshold_vc"), "arrival")


def switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate switches from purchases, each open for 1 hour and more."""
    rows = as_sensors(events(spark, sf_dir)).where(F.col("event_type") == "purchase")
    hours = (F.col("vc") + 1).cast("bigint")
    return rows.select("event_id", "id", (hours * 3_600_000).alias("duration_ms"), "arrival")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines: the documents, in doc_id order."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("line"))
