"""Record schemas. All are fixed; none is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])

SENSOR = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("vc", T.IntegerType()),
])

MARKETING = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])

# JSON field names of a threshold rule are part of its wire format.
THRESHOLD_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("thresholdVc", T.IntegerType()),
])

SWITCH = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
])
