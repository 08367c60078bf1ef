"""Line feeds: text files, sockets, message queues, in-memory collections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Bounded text, one row per line."""
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Text files as a stream, one row per line; new files are picked up."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).withColumnRenamed("value", "line")


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket. For trials only: a socket cannot be replayed after a failure."""
    return (
        spark.readStream.format("socket").option("host", host).option("port", port).load()
        .select(F.col("value").alias("line"))
    )


def queue_options(brokers: str, topic: str, group: str) -> dict[str, str]:
    """Options of the message-queue reader."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": "latest",
    }


def queue_lines(spark: SparkSession, brokers: str, topic: str, group: str) -> DataFrame:
    """String values of a topic; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**queue_options(brokers, topic, group))
    return reader.load().select(F.col("value").cast("string").alias("line"))


def collection(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small in-memory collection as rows."""
    return spark.createDataFrame(list(rows), schema)
