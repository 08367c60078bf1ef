"""Late rows of a stream as a second output.

The engine drops late rows inside stateful operators without handing them out.
Here rows are split before any aggregate, against a high-water mark kept per
batch in a small table. A retried batch reads the mark of the batch before it
and overwrites its own outputs, so the split is repeatable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brook.functions.durations import interval, micros, to_micros
from brook.operators.eventtime import TICK

_MARK = T.StructType([T.StructField("batch", T.LongType()), T.StructField("top", T.LongType())])


def _mark_before(spark: SparkSession, marks: str, batch_id: int) -> int | None:
    """Greatest event time of all batches before this one, one number."""
    if batch_id == 0:
        return None
    return spark.read.schema(_MARK).parquet(f"{marks}/batch_id={batch_id - 1}").agg(F.max("top")).first()[0]


def split_writer(root: str, size: str = "5 seconds", bound: str = "2 seconds",
                 lateness: str = "2 seconds") -> Callable[[DataFrame, int], None]:
    """A batch writer: rows in time to ``root/main``, too late ones to ``root/late``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _mark_before(spark, f"{root}/marks", batch_id)
        last = F.window("ts", size)["end"] - interval(TICK) + interval(lateness)
        is_late = F.lit(False) if mark is None else to_micros(last) <= F.lit(mark - micros(bound))
        batch = batch.persist()
        try:
            batch.where(~is_late).write.mode("overwrite").parquet(f"{root}/main/batch_id={batch_id}")
            batch.where(is_late).write.mode("overwrite").parquet(f"{root}/late/batch_id={batch_id}")
            top = F.greatest(F.max(to_micros("ts")), F.lit(mark).cast("bigint"))
            batch.agg(top.alias("top")).select(F.lit(batch_id).cast("bigint").alias("batch"), "top").write.mode(
                "overwrite").parquet(f"{root}/marks/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write
