"""Registered offset-ledger queries over Kafka-shaped events."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import offsets as off
from lakeloom.plans import derived
from lakeloom.plans.registry import query

GROUP = "lakeloom-consumer"
CUTOFF = "2024-01-20"  # history written by a consumer that stopped on this day
LAST_BATCH = "2024-01-30 23:50:00"  # start of the final micro-batch


def _records(spark, sf):
    return derived.kafka_records(spark, sf).withColumn("value", F.col("value").cast("string"))


def _whole_history(spark, sf):
    return off.offset_history(_records(spark, sf), GROUP, off.batch_ms("timestamp"))


def _history(spark, sf):
    """What a consumer stored that stopped at the cutoff and never saw partition 3."""
    rec = _records(spark, sf).where(F.col("timestamp") < F.lit(CUTOFF).cast("timestamp"))
    rec = rec.where(F.col("partition") != 3)
    return off.offset_history(rec, GROUP, off.batch_ms("timestamp"))


@query("topic_partitions")
def q_topic_partitions(spark, sf):
    return off.topic_partitions(_records(spark, sf))


@query("last_per_partition")
def q_last_per_partition(spark, sf):
    return off.last_per_partition(_records(spark, sf))


@query("offset_snapshot")
def q_offset_snapshot(spark, sf):
    return off.offset_snapshot(_records(spark, sf))


@query("offset_history")
def q_offset_history(spark, sf):
    return off.offset_history(_records(spark, sf), GROUP, off.batch_ms("timestamp"))


@query("offsets_encode")
def q_offsets_encode(spark, sf):
    return off.encode_offsets(_whole_history(spark, sf), ["topic", "group_id", "batch_ms"],
                              "until_offset")


@query("offsets_decode")
def q_offsets_decode(spark, sf):
    enc = off.encode_offsets(_whole_history(spark, sf), ["topic", "group_id", "batch_ms"],
                             "until_offset")
    return off.decode_offsets(enc.withColumnRenamed("topic", "t"), ["group_id", "batch_ms"],
                              "offsets", "until_offset")


@query("offsets_from_batch")
def q_offsets_from_batch(spark, sf):
    fr = off.offsets_from_batch(_records(spark, sf), off.batch_ms("timestamp"))
    return off.encode_offsets(fr, ["topic", "batch_ms"], "from_offset")


@query("resolve_offsets")
def q_resolve_offsets(spark, sf):
    return off.resolve_offsets(_history(spark, sf), _records(spark, sf), GROUP)


@query("starting_offsets_json")
def q_starting_offsets_json(spark, sf):
    res = off.resolve_offsets(_history(spark, sf), _records(spark, sf), GROUP)
    return off.starting_offsets_json(res)


@query("offset_payload_join")
def q_offset_payload_join(spark, sf):
    """Offset range of every partition for the final ten-minute micro-batch,
    with the newest payload it carried ('' for partitions without data)."""
    rec = _records(spark, sf)
    start = F.lit(LAST_BATCH).cast("timestamp")
    after = F.col("offset") + 1
    ranges = rec.groupBy("topic", "partition").agg(
        F.coalesce(F.max(F.when(F.col("timestamp") < start, after)), F.lit(0).cast("bigint")).alias("from_offset"),
        F.max(after).alias("until_offset"))
    last_batch = rec.where(F.col("timestamp") >= start)
    payload = off.offset_snapshot(last_batch).select("topic", "partition", "data")
    return off.attach_payload(ranges, payload)
