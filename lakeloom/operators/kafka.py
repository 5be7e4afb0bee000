"""Kafka record → application-log table (works on batch and stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.reshape import flatten
from lakeloom.schemas import APP_LOG_SCHEMA

FIELDS = [f.name for f in APP_LOG_SCHEMA.fields if f.name != "events"]


def parse_app_log(records: DataFrame, fields=FIELDS) -> DataFrame:
    """key/topic/offset as strings, value JSON parsed with the fixed
    schema and flattened; the nested ``events`` struct is kept as JSON."""
    parsed = records.select(
        F.col("key").cast("string").alias("key"), F.col("topic"),
        F.col("offset").cast("string").alias("offset"),
        F.from_json(F.col("value").cast("string"), APP_LOG_SCHEMA).alias("value"))
    return flatten(parsed, "value", fields, keep=["key", "topic", "offset"], as_json=["events"])
