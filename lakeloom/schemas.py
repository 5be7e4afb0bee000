"""Schema constants."""

from pyspark.sql import types as T

S = T.StringType()

# Kafka source record (columns used by the jobs).
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", S),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Field names of the application-log JSON carried in Kafka values.
APP_LOG_EVENT = T.StructType([T.StructField(n, S) for n in (
    "event_type", "event_id", "event_ts", "event_arg1", "event_arg2", "event_arg3")])
APP_LOG_SCHEMA = T.StructType(
    [T.StructField(n, S) for n in (
        "create_time", "imei", "mac", "os_version", "bu", "app_version",
        "user_uuid", "net", "ip", "gps")]
    + [T.StructField("events", APP_LOG_EVENT)])

CONTACT = T.StructType([T.StructField("name", S), T.StructField("phone", S)])

# Long "cells" form of a key-value table (one value per row/family/qualifier/version).
CELL_SCHEMA = T.StructType([
    T.StructField("row_key", S, False),
    T.StructField("family", S, False),
    T.StructField("qualifier", S, False),
    T.StructField("version", T.LongType(), False),
    T.StructField("value", S),
])

# Offset ledger, one row per (topic, group, batch, partition).
LEDGER_SCHEMA = T.StructType([
    T.StructField("topic", S, False),
    T.StructField("group_id", S, False),
    T.StructField("batch_ms", T.LongType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("until_offset", T.LongType(), False),
])
