"""What the external sinks receive, as frames, and the writers that send it.

The payload is a frame so that it can be checked without the external system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.durations import to_micros


def queue_payload(df: DataFrame) -> DataFrame:
    """Records as JSON text in the ``value`` column of a queue message."""
    fields = [
        F.floor(to_micros(c) / 1000).cast("bigint").alias(c) if t.startswith("timestamp") else F.col(c)
        for c, t in df.dtypes
    ]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def queue_writer(stream: DataFrame, brokers: str, topic: str, checkpoint: str):
    """Streaming writer to a queue topic; needs the Kafka connector."""
    return (
        queue_payload(stream).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers).option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def jdbc_rows(behaviors: DataFrame) -> DataFrame:
    """The three columns of the relational table: user id narrowed, item id as text.

    An id beyond 32 bits wraps around, as a narrowing conversion does; it never fails the write.
    """
    low = F.col("user_id").bitwiseAND(0xFFFFFFFF)
    return behaviors.select(
        F.when(low >= 2**31, low - 2**32).otherwise(low).cast("int").alias("user_id"),
        F.col("item_id").cast("string").alias("item_id"),
        "behavior",
    )


def jdbc_writer(url: str, table: str, driver: str, batch_size: int = 1000, **properties: str):
    """A ``foreachBatch`` function that appends rows through JDBC.

    JDBC appends are at-least-once: a retried batch may insert rows twice
    unless the table's key refuses them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            jdbc_rows(batch).write.format("jdbc").mode("append")
            .options(url=url, dbtable=table, driver=driver, batchsize=batch_size, **properties).save()
        )

    return write


def kv_running(counts: DataFrame, key: str, value: str = "n") -> DataFrame:
    """Running counts (an update-mode aggregate) as text pairs; the last value of each key wins."""
    return counts.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))


def kv_latest(views: DataFrame) -> DataFrame:
    """``user -> page views`` of a bounded table. On a stream count first, then use ``kv_running``."""
    return kv_running(views.groupBy("user_id").agg(F.count("*").alias("n")), "user_id")


def documents(behaviors: DataFrame, order: tuple[str, ...] = ("ts", "item_id")) -> DataFrame:
    """One document per user, the last write wins; all fields are text."""
    last = behaviors.groupBy("user_id").agg(
        F.max_by(F.struct("item_id", "behavior"), F.struct(*order)).alias("_d"))
    doc = F.struct(
        F.col("user_id").cast("string").alias("userID"),
        F.col("_d.item_id").cast("string").alias("itemId"),
        F.col("_d.behavior").alias("behavior"),
    )
    return last.select(F.col("user_id").cast("string").alias("doc_id"), F.to_json(doc).alias("source"))


def upsert_writer(send, payload):
    """A ``foreachBatch`` function for key-value and document stores.

    ``payload`` turns a micro-batch into rows with one row per key, ``send``
    is a function over an iterator of rows that opens its own client; it runs
    once per partition on the executors. Upserts make a retried batch harmless.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        payload(batch).foreachPartition(send)

    return write
