"""Read a query's keyed state from outside, as a table of its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_state(spark: SparkSession, checkpoint: str, state: str | None = None) -> DataFrame:
    """Rows (key, value) of a named state variable, or of a plain aggregate's state.

    The state of the last committed batch is read; the query may be running.
    """
    reader = spark.read.format("statestore").option("path", checkpoint)
    if state:
        reader = reader.option("stateVarName", state)
    return reader.load()


def lookup(spark: SparkSession, checkpoint: str, state: str, key: str) -> DataFrame:
    """The state of one key."""
    rows = read_state(spark, checkpoint, state)
    name = rows.schema["key"].dataType.names[0]
    return rows.where(rows[f"key.{name}"] == key).select("key", "value")


def read_list(spark: SparkSession, checkpoint: str, state: str) -> DataFrame:
    """Rows (key, value) of a named list state, one for every element that a key holds."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", state)
    rows = reader.option("flattenCollectionTypes", "true").load()
    return rows.select("key", F.col("list_element").alias("value"))
