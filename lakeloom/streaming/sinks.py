"""Sinks, triggers and the offset-ledger writer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators import offsets as off

FILE_SINKS = {"parquet", "orc", "json", "csv", "text"}


def trigger_kwargs(processing_time: str | None = None, available_now: bool = False,
                   continuous: str | None = None, once: bool = False) -> dict:
    """Exactly one trigger; several given is an error (the last one would
    silently win otherwise)."""
    given = {k: v for k, v in {"processingTime": processing_time,
                               "availableNow": available_now or None,
                               "continuous": continuous, "once": once or None}.items() if v}
    if len(given) > 1:
        raise ValueError(f"one trigger only, got {sorted(given)}")
    return given


def check_sink(fmt: str, output_mode: str, trigger: dict) -> None:
    if fmt in FILE_SINKS and output_mode != "append":
        raise ValueError(f"{fmt} sink supports append mode only")
    if "continuous" in trigger and fmt not in {"kafka", "memory", "console", "foreach"}:
        raise ValueError(f"continuous trigger is not supported by the {fmt} sink")


def start(df: DataFrame, fmt: str, output_mode: str, checkpoint: str, path: str | None = None,
          query_name: str | None = None, partition_by: list[str] | None = None,
          **trigger) -> StreamingQuery:
    """Start a streaming write after validating mode/trigger/sink."""
    trig = trigger_kwargs(**trigger)
    check_sink(fmt, output_mode, trig)
    w = df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if path:
        w = w.option("path", path)
    if query_name:
        w = w.queryName(query_name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "console":
        w = w.option("truncate", "false")
    if trig:
        w = w.trigger(**trig)
    return w.start()


def batch_log_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that stores each micro-batch under
    ``batch_id=<n>``, overwriting that folder only: a batch replayed after
    a failure replaces its own output, so the log is exactly-once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def latest_revision(log: DataFrame, keys: list[str]) -> DataFrame:
    """Final state from an update-mode log: the newest revision per key."""
    rest = [c for c in log.columns if c not in keys and c != "batch_id"]
    return (log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r"))
            .select(*keys, "_r.*"))


def offset_ledger_writer(path: str, value_col: str = "value") -> Callable[[DataFrame, int], None]:
    """foreachBatch function storing, per (topic, partition), the
    until-offset together with the newest payload, in one write keyed by
    batch id (empty batches write nothing)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # One pass over the batch: reduce it to one row per partition, keep
        # that small result for the emptiness guard and the write.
        snap = off.offset_snapshot(batch, value_col).withColumn("batch_id", F.lit(batch_id))
        snap = snap.persist()
        try:
            if snap.isEmpty():
                return
            snap.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            snap.unpersist()
    return write


def committed_offsets(ledger: DataFrame) -> DataFrame:
    """Newest (until_offset, data) per partition from the ledger log."""
    # The last batch decides, not the highest offset: after a rewind or a
    # recreated topic the newest commit is the lower one.
    return (ledger.groupBy("topic", "partition")
            .agg(F.max_by(F.struct("until_offset", "data"), "batch_id").alias("_c"))
            .select("topic", "partition", "_c.until_offset", "_c.data"))


def at_least_once_writer(ledger_path: str, process: Callable[[DataFrame, int], None]
                         ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that first records, per (topic, partition), the
    offset the batch starts from, then processes it. A crash during
    ``process`` leaves the ledger pointing at the batch start, so a consumer
    resuming from the ledger replays the batch (at-least-once); the default
    checkpointed path (``offset_ledger_writer``) is exactly-once instead."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read the micro-batch once for both steps
        try:
            starts = (batch.groupBy("topic", "partition")
                      .agg(F.min("offset").alias("from_offset"))
                      .withColumn("batch_id", F.lit(batch_id)))
            starts.write.mode("overwrite").parquet(f"{ledger_path}/batch_id={batch_id}")
            process(batch, batch_id)
        finally:
            batch.unpersist()
    return write
