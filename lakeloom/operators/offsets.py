"""Kafka offset ledgers as tables.

Records are Kafka-shaped (topic, partition, offset, key, value, timestamp).
The ledger stores, per (topic, group_id, batch_ms, partition), the offset
to resume from (``until_offset`` = last processed + 1). Everything is a
grouped aggregate or a small join; nothing loops on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def topic_partitions(records: DataFrame) -> DataFrame:
    """Partitions present per topic, with their record counts."""
    return records.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("records"))


def last_per_partition(records: DataFrame, value: str = "value") -> DataFrame:
    """Newest record of every (topic, partition)."""
    return records.groupBy("topic", "partition").agg(
        F.max("offset").alias("last_offset"), F.max_by(value, "offset").alias("last_value"))


def offset_snapshot(records: DataFrame, value: str = "value") -> DataFrame:
    """Until-offset and the payload of the newest record, one row per
    (topic, partition) — offset and data stored together, atomically."""
    return records.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("until_offset"), F.max_by(value, "offset").alias("data"))


def batch_ms(ts: str | Column, unit: str = "DAY") -> Column:
    """Epoch milliseconds of the start of the ``unit`` containing ``ts``.

    Days are computed from the calendar date (``unix_date`` × 86,400,000):
    for wall-clock (TIMESTAMP_NTZ) input this does not depend on the session
    time zone and every day is 24 h long, also across DST changes. Other
    units truncate the instant in the session time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if unit.upper() == "DAY":
        return F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000)
    return F.unix_millis(F.date_trunc(unit, c.cast("timestamp")))


def offset_history(records: DataFrame, group_id: str, batch: Column) -> DataFrame:
    """Ledger rows per batch: until-offset of each partition that had data."""
    return (records.groupBy("topic", F.lit(group_id).alias("group_id"),
                            batch.alias("batch_ms"), "partition")
            .agg((F.max("offset") + 1).alias("until_offset")))


def offsets_from_batch(records: DataFrame, batch: Column) -> DataFrame:
    """From-offset (first offset) of every partition in each batch."""
    return (records.groupBy("topic", batch.alias("batch_ms"), "partition")
            .agg(F.min("offset").alias("from_offset")))


def encode_offsets(df: DataFrame, group_cols: Sequence[str], offset_col: str,
                   name: str = "offsets") -> DataFrame:
    """``topic:partition:offset,...`` per group, partitions ascending.
    One string per group holds one entry per partition (bounded)."""
    entries = F.array_sort(F.collect_list(F.struct("partition", "topic", offset_col)))
    return df.groupBy(*group_cols).agg(F.array_join(F.transform(entries, lambda e: F.concat_ws(
        ":", e["topic"], e["partition"].cast("string"), e[offset_col].cast("string"))), ",")
        .alias(name))


def decode_offsets(df: DataFrame, keys: Sequence[str], c: str,
                   offset_name: str = "offset") -> DataFrame:
    """Inverse of :func:`encode_offsets`. Malformed entries are dropped
    (an entry needs exactly topic:partition:offset with integer parts)."""
    e = df.select(*keys, F.explode(F.split(F.col(c), ",")).alias("_e"))
    parts = F.split(F.col("_e"), ":")
    out = e.select(*keys, F.try_element_at(parts, F.lit(1)).alias("topic"),
                   F.try_element_at(parts, F.lit(2)).try_cast("int").alias("partition"),
                   F.try_element_at(parts, F.lit(3)).try_cast("bigint").alias(offset_name),
                   F.size(parts).alias("_n"))
    return out.where((F.col("_n") == 3) & F.col("partition").isNotNull()
                     & F.col(offset_name).isNotNull() & (F.col("topic") != "")).drop("_n")


def latest_commit(history: DataFrame) -> DataFrame:
    """Newest committed until-offset of every (topic, group_id, partition).

    A ``max_by`` aggregate (partial, map-side) rather than a rank window
    that would put the whole history of a topic in one task.
    """
    return history.groupBy("topic", "group_id", "partition").agg(
        F.max_by("until_offset", "batch_ms").alias("until_offset"),
        F.max("batch_ms").alias("batch_ms"))


def resolve_offsets(history: DataFrame, current: DataFrame, group_id: str) -> DataFrame:
    """Start offset per (topic, partition) for a consumer group.

    * no history → 0 for every current partition;
    * more partitions now than stored → stored, plus 0 for new ones;
    * otherwise → stored (stored partitions are kept if the topic shrank).
    Partitions are numbered from 0, so one full outer join covers all three.
    """
    stored = latest_commit(history.where(F.col("group_id") == group_id)) \
        .select("topic", "partition", "until_offset")
    cur = current.select("topic", "partition").distinct()
    j = stored.join(cur, ["topic", "partition"], "full_outer")
    return j.select("topic", "partition",
                    F.coalesce("until_offset", F.lit(0).cast("bigint")).alias("from_offset"))


def starting_offsets_json(resolved: DataFrame, offset_col: str = "from_offset") -> DataFrame:
    """One row: the ``startingOffsets`` JSON for the Kafka source,
    ``{"topic":{"0":n,...}}`` (partitions ascending within each topic)."""
    per_topic = resolved.groupBy("topic").agg(F.map_from_entries(F.transform(
        F.array_sort(F.collect_list(F.struct("partition", offset_col))),
        lambda e: F.struct(e["partition"].cast("string"), e[offset_col]))).alias("m"))
    by_topic = F.array_sort(F.collect_list(F.struct("topic", "m")), lambda a, b: F.when(
        a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0))
    return per_topic.agg(F.to_json(F.map_from_entries(by_topic)).alias("starting_offsets"))


def attach_payload(ranges: DataFrame, payload: DataFrame, default: str = "") -> DataFrame:
    """Offset ranges with the partition's last payload, ``default`` if none."""
    j = ranges.join(payload, ["topic", "partition"], "left")
    return j.withColumn("data", F.coalesce(F.col("data"), F.lit(default)))


def kafka_start_options(ledger: DataFrame | None, current: DataFrame, topic: str,
                        group_id: str) -> dict[str, str]:
    """Kafka source options for a consumer that keeps its own ledger.

    With a ledger: ``assign`` the resolved partitions and start from the
    stored offsets (new partitions from 0). Without one: ``subscribe`` at
    ``latest`` (the ledger is created by the first batch). Only the one
    JSON row (one entry per partition) reaches the driver.
    """
    if ledger is None:
        return {"subscribe": topic, "startingOffsets": "latest"}
    # No ledger entry and no partition known yet: nothing to assign.
    resolved = resolve_offsets(ledger.where(F.col("topic") == topic),
                               current.where(F.col("topic") == topic), group_id)
    starting = starting_offsets_json(resolved).first()["starting_offsets"]
    import json

    parts = {t: sorted(int(p) for p in m) for t, m in json.loads(starting or "{}").items() if m}
    if not parts:
        return {"subscribe": topic, "startingOffsets": "latest"}
    return {"assign": json.dumps(parts), "startingOffsets": starting}
