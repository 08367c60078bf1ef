"""Text records to typed rows. A bad line goes to a second frame, never lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brook import schemas
from brook.functions.durations import from_seconds


def _field(parts: str, i: int, kind: str | None = None) -> Column:
    value = F.get(F.col(parts), F.lit(i))
    return value.try_cast(kind) if kind else value


def _split(good: Column, parsed: DataFrame, columns: list[str], line: str) -> tuple[DataFrame, DataFrame]:
    return parsed.where(good).select(*columns), parsed.where(~good).select(line)


def behavior_csv(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """``user,item,category,behavior,seconds`` as (rows, bad lines)."""
    rows = lines.withColumn("_p", F.split(line, ","))
    rows = rows.select(
        line,
        _field("_p", 0, "bigint").alias("user_id"),
        _field("_p", 1, "bigint").alias("item_id"),
        _field("_p", 2, "int").alias("category_id"),
        _field("_p", 3).alias("behavior"),
        _field("_p", 4, "bigint").alias("_s"),
    )
    good = F.lit(True)
    for c in ("user_id", "item_id", "category_id", "behavior", "_s"):
        good = good & F.col(c).isNotNull()
    rows = rows.withColumn("ts", from_seconds("_s"))
    return _split(good, rows, ["user_id", "item_id", "category_id", "behavior", "ts"], line)


def sensor_csv(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """``id,seconds,level`` as (rows, bad lines)."""
    rows = lines.withColumn("_p", F.split(line, ","))
    rows = rows.select(
        line,
        _field("_p", 0).alias("id"),
        _field("_p", 1, "bigint").alias("_s"),
        _field("_p", 2, "int").alias("vc"),
    )
    good = F.col("id").isNotNull() & F.col("_s").isNotNull() & F.col("vc").isNotNull()
    rows = rows.withColumn("ts", from_seconds("_s"))
    return _split(good, rows, ["id", "ts", "vc"], line)


def threshold_json(lines: DataFrame, line: str = "line") -> DataFrame:
    """JSON rules; malformed and null lines are passed over."""
    rule = F.from_json(F.col(line), schemas.THRESHOLD_JSON)
    rows = lines.select(rule.alias("r"))
    return rows.where(F.col("r.id").isNotNull() & F.col("r.thresholdVc").isNotNull()).select(
        F.col("r.id").alias("id"), F.col("r.thresholdVc").alias("threshold_vc"))
