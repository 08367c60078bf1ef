"""Feeds for streaming queries and ways to run them to the end of the input."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brook import schemas


def event_feed(spark: SparkSession, path: str, files_per_trigger: int = 100,
               schema: T.StructType = schemas.EVENTS) -> DataFrame:
    """Stored rows as a stream; event times become zoned, as watermarks need.

    ``path`` may be a folder of parquet files or one file. A file is named by a
    pattern that only it matches, since a stream's base path must be a folder.
    """
    head, dot, tail = path.rpartition(".")
    pattern = f"{head}.[{tail[0]}]{tail[1:]}" if dot and "/" not in tail else path
    raw = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(pattern)
    )
    return zoned(raw)


#: Rows of one feed file; a feed has FEED_FILES files at least. A micro-batch takes FILES_PER_BATCH files, so its size is bounded.
FEED_ROWS, FEED_FILES, FILES_PER_BATCH = 1_000_000, 10, 2


def ordered_feed(rows: DataFrame, order: Sequence[str], path: str) -> DataFrame:
    """Stored rows as a stream that delivers them in ``order``, whatever files they were stored in.

    The rows are range-partitioned into sorted files, and the files' times are set in that order, since a file stream
    takes files by time. A trigger takes whole files, so every micro-batch continues where the one before ended.
    """
    ordered_files(rows, order, path)
    return event_feed(rows.sparkSession, path, FILES_PER_BATCH, rows.schema)


def ordered_files(rows: DataFrame, order: Sequence[str], path: str) -> None:
    """Writes sorted files whose times rise in that order.

    Raises where the store does not keep the times that were set: a feed in another order would give wrong answers.
    """
    spark = rows.sparkSession
    n = max(FEED_FILES, -(-rows.count() // FEED_ROWS))
    rows.repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def listed() -> dict[str, int]:
        found = {f.getPath().getName(): f.getModificationTime() for f in files.listStatus(folder)}
        return {name: found[name] for name in sorted(found) if name.startswith("part-")}

    now, names = int(time.time()), list(listed())  # names only: as many as there are files
    for place, name in enumerate(names):
        files.setTimes(hadoop.Path(folder, name), (now - len(names) + place) * 1000, -1)
    kept = list(listed().values())
    if any(a >= b for a, b in zip(kept, kept[1:])):
        raise RuntimeError(f"{path}: the store does not keep file times, so the order of the feed would be lost")


def zoned(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as timestamps of the session zone (UTC)."""
    return df.withColumns({
        f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType == T.TimestampNTZType()
    })


def zoneless(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType == T.TimestampType()
    })


IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def _idle_batches(spark: SparkSession, wanted: bool):
    """Whether the engine may run batches without data.

    A processor on processing time always asks for one more, so a run that is
    to end with its input must do without; its timers then fire with new data.
    """
    before = spark.conf.get(IDLE)
    spark.conf.set(IDLE, str(wanted).lower())
    try:
        yield
    finally:
        spark.conf.set(IDLE, before)


@contextmanager
def local_sessions(spark: SparkSession):
    """Session rows of a key are merged inside each task before the exchange."""
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drain(stream: DataFrame, out: str, checkpoint: str, label: str | None = None, idle: bool = True):
    """Append everything available to a parquet table; returns the finished query.

    Pass ``idle=False`` for processors on processing time.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    if label:
        writer = writer.queryName(label)
    with _idle_batches(stream.sparkSession, idle):
        query = (
            writer.option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query


def drain_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "update", idle: bool = True):
    """Hand every micro-batch to ``write``; returns the finished query."""
    with _idle_batches(stream.sparkSession, idle):
        query = (
            stream.writeStream.foreachBatch(write).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query


def keep_running(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                 mode: str = "update", every: str = "1 second"):
    """Start a query that runs until stopped and resumes from its checkpoint."""
    return (
        stream.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    )


def batch_table(out: str) -> Callable[[DataFrame, int], None]:
    """A batch writer whose retry overwrites its own earlier attempt."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return write


def two_outputs(root: str, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
                names: tuple[str, str] = ("main", "side")) -> Callable[[DataFrame, int], None]:
    """A batch writer for an operator with a side output; the batch is read once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, part in zip(names, split(batch)):
                part.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def latest_metric(query, group: str, name: str):
    """The current value of an observed metric: what a gauge shows on demand."""
    for progress in reversed(query.recentProgress):
        metrics = progress["observedMetrics"].get(group)
        if metrics is not None and metrics[name] is not None:  # a batch without rows shows nothing new
            return metrics[name]
    return None


def watermark_gauge(query) -> str | None:
    """The watermark of the last batch that had one."""
    for progress in reversed(query.recentProgress):
        if progress["eventTime"].get("watermark"):
            return progress["eventTime"]["watermark"]
    return None


def latest_per_key(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The last written row of every key of an update-mode table."""
    rows = spark.read.parquet(out)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("_v"))
    return last.select(*keys, "_v.*")


def console(stream: DataFrame, label: str, checkpoint: str, mode: str = "append"):
    """Print results under a label; returns the running query."""
    return (
        stream.writeStream.format("console").queryName(label).outputMode(mode)
        .option("checkpointLocation", checkpoint).option("truncate", False).start()
    )
