"""Registered streaming jobs that survive interruption: two sources with
watermarks of their own, batches that die midway, per-partition state with
timers, a sink that commits by itself, and a query that stays up."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.plans import derived
from lakeloom.plans.registry import query
from lakeloom.plans.streams import (
    SENTINEL_TS,
    _devices,
    _newest_windows,
    _sliding,
    _views_clicks,
    event_drops,
    time_drops,
)
from lakeloom.schemas import KAFKA_SCHEMA
from lakeloom.session import scratch_path
from lakeloom.streaming import ledger_sink, ops, recovery, sinks, stateful
from lakeloom.streaming.replay import (
    read_sink,
    run_available_now,
    run_in_drops,
    run_side_by_side,
    run_while_arriving,
)
from lakeloom.streaming.sources import file_stream
from lakeloom.tables import load

DIES_AT = 1  # the batch that is interrupted
GAPS_END_TS = "2200-01-01 00:00:00"  # state functions take times up to 2262


def lagging_rounds(spark, sf):
    """Views as they happen, clicks one round later; at the end both sides'
    clocks are moved on by a far-future row of no user. (A side without a row
    in a run knows no more than the watermark that the checkpoint holds.)"""
    views, clicks = ([side for side in sides] for sides in zip(*[
        _views_clicks(ops.event_time(d, "ts")) for d in event_drops(spark, sf)]))
    end = [spark.range(1).select(
        F.lit(-n).cast("bigint").alias(f"{side}_id"), F.lit(-n).cast("bigint").alias(f"{side}_user"),
        F.lit(SENTINEL_TS).cast("timestamp").alias(f"{side}_ts")) for n, side in ((1, "view"), (2, "click"))]
    return list(zip([*views, None, end[0]], [None, *clicks, end[1]]))


def join_views_clicks(views, clicks):
    joined = ops.interval_join(views, clicks, "view_user", "click_user", "view_ts", "click_ts",
                               "2 hours", "3 hours", "1 hour", how="left_outer")
    return joined.select("view_id", "click_id", F.col("view_user").alias("user_id"))


@query("stream_two_watermarks")
def q_stream_two_watermarks(spark, sf):
    """Left interval join of two sources that progress apart: under the
    ``min`` policy the slow side holds the watermark back and nothing is lost."""
    out = run_side_by_side(lagging_rounds(spark, sf), join_views_clicks, "append", "twowm")
    return out.where("view_id >= 0")


@query("stream_resume")
def q_stream_resume(spark, sf):
    """Sliding counts whose second batch dies after it has written half its
    rows: state and offsets go on from the last commit, the batch is run again
    under its id and replaces what it left."""
    drops = event_drops(spark, sf)
    inbox, base = scratch_path(spark, "resume-in"), scratch_path(spark, "resume")
    half = F.pmod(F.xxhash64("window_start", "event_type"), F.lit(2)) == 0
    writer = lambda sink: recovery.dies_midway(sinks.batch_log_writer(sink), DIES_AT, half)
    kept = {}
    sink = None
    for i, drop in enumerate(drops):
        drop.write.parquet(f"{inbox}/d{i}")

        def run(attempt):
            out = _sliding(file_stream(spark, f"{inbox}/d*", drop.schema))
            write = kept.setdefault("write", writer(f"{base}/sink"))  # one failure in all
            return run_available_now(out, None, "update", "resume", foreach_batch=lambda _: write, base=base)

        (sink, _), _ = recovery.run_with_restarts(run)
    log_schema = "window_start timestamp, window_end timestamp, event_type string, cnt bigint, batch_id int"
    return _newest_windows(read_sink(spark, sink, spark.createDataFrame([], log_schema).schema))


@query("stream_resume_sink")
def q_stream_resume_sink(spark, sf):
    """Rows to a file sink whose tasks die in the second drop after some files
    are written: the files of the dead batch are no part of the sink."""
    inbox, base = scratch_path(spark, "resumesink-in"), scratch_path(spark, "resumesink")
    sink, schema = None, None
    for i, drop in enumerate(event_drops(spark, sf)):
        drop.write.parquet(f"{inbox}/d{i}")

        def run(attempt):
            out = file_stream(spark, f"{inbox}/d*", drop.schema)
            if i == DIES_AT and attempt == 0:
                out = recovery.failing_rows(out, F.pmod(F.xxhash64("event_id"), F.lit(50)) == 0, "user_id")
            out = out.select("event_id", "user_id", "event_type")
            return run_available_now(out, "parquet", "append", "resumesink", base=base)[0], out.schema

        (sink, schema), _ = recovery.run_with_restarts(run)
    return read_sink(spark, sink, schema)


def gap_records(spark, sf):
    """Records in the order of their offsets, as a topic delivers them, and at
    the end one far-future record of a partition that is none."""
    rec = derived.kafka_records(spark, sf).select(
        "topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("data"))
    end = spark.range(1).select(F.lit(derived.TOPIC).alias("topic"), F.lit(-1).alias("partition"),
                                F.lit(0).cast("bigint").alias("offset"),
                                F.lit(GAPS_END_TS).cast("timestamp").alias("timestamp"),
                                F.lit(None).cast("string").alias("data"))
    return [*time_drops(rec, "offset"), end]


@query("stream_offset_gaps")
def q_stream_offset_gaps(spark, sf):
    """Missing offsets of every partition over all batches, and at the end,
    when every partition has been silent long enough, its last record."""
    with recovery.session_conf(spark, recovery.ROCKSDB):
        out = run_in_drops(gap_records(spark, sf),
                           lambda s: stateful.offset_gaps(s, idle_ms=365 * 86_400_000), "parquet", "append", "gaps")
    return out.where("partition IS NULL OR partition >= 0")


@query("stream_commit_ledger")
def q_stream_commit_ledger(spark, sf):
    """Until-offset and newest payload of every partition, committed by the
    sink's own writer in one step per batch; the last commit of each holds."""
    ledger_sink.register(spark)
    inbox, base = scratch_path(spark, "commit-in"), scratch_path(spark, "commit")
    for i, drop in enumerate(time_drops(derived.kafka_records(spark, sf), "timestamp")):
        drop.write.parquet(f"{inbox}/d{i}")
        stream = file_stream(spark, f"{inbox}/d*", KAFKA_SCHEMA)
        run_available_now(stream.select("topic", "partition", "offset", F.col("value").cast("string").alias("data")),
                          ledger_sink.FORMAT, "append", "commit", base=base)
    return sinks.committed_offsets(ledger_sink.ledger(spark, f"{base}/sink"))


@query("stream_processing_time")
def q_stream_processing_time(spark, sf):
    """Running counts of a query that stays up, on a processing-time trigger,
    while its input arrives."""
    log = run_while_arriving(event_drops(spark, sf), lambda s: ops.running_count(_devices(s), ["deviceType"]),
                             "update", "proctime", sinks.batch_log_writer)
    return sinks.latest_revision(log, ["deviceType"])
