"""Registered streaming jobs.

Each one reads the input tables as a file stream, runs the streaming
query to completion with ``availableNow`` (including the trailing no-data
batch that advances watermarks) and returns the sink read back as a batch
frame. Sinks and checkpoints live under the shared checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators import offsets as off
from lakeloom.operators.kafka import parse_app_log
from lakeloom.operators.text import words
from lakeloom.plans import derived
from lakeloom.plans.registry import query
from lakeloom.schemas import KAFKA_SCHEMA
from lakeloom.session import scratch_path
from lakeloom.streaming import ops, sinks
from lakeloom.sources.files import path_kind
from lakeloom.streaming.replay import read_sink, run_available_now, run_in_drops, stage_files
from lakeloom.streaming.sources import file_stream
from lakeloom.tables import load

SENTINEL_TS = "2999-01-01 00:00:00"
LEDGER_GROUP = "lakeloom-stream"
DROPS = 3  # micro-batches with data in which a table arrives


def table_stream(spark, sf, name):
    """The table as a streaming source, for either layout: a directory of
    part files is watched directly; a single parquet file is picked from its
    folder by exact name (no glob in the path, so nothing else matches)."""
    batch = load(spark, sf, name)
    path = f"{sf.rstrip('/')}/{name}.parquet"
    if path_kind(spark, path) == "file":
        return file_stream(spark, sf, batch.schema, glob=f"{name}.parquet")
    return file_stream(spark, path, batch.schema)


def events_stream(spark, sf):
    return ops.event_time(table_stream(spark, sf, "events"), "ts")


def time_drops(df, ts, n=DROPS):
    """``df`` in ``n`` drops of equal time spans, oldest first, as it would
    arrive; rows without a time come first. Only the span reaches the driver."""
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    if lo is None or lo == hi:
        return [df]
    cuts = [F.lit(lo + (hi - lo) * k / n).cast(df.schema[ts].dataType) for k in range(1, n)]
    t = F.col(ts)
    first = [df.where(t.isNull() | (t < cuts[0]))]
    inner = [df.where((t >= a) & (t < b)) for a, b in zip(cuts, cuts[1:])]
    return first + inner + [df.where(t >= cuts[-1])]


def event_drops(spark, sf):
    return time_drops(load(spark, sf, "events"), "ts")


def ntz(*cols):
    return {c: F.col(c).cast("timestamp_ntz") for c in cols}


@query("stream_word_count")
def q_stream_word_count(spark, sf):
    """Documents arrive in drops; each revises the counts of its words."""
    docs = load(spark, sf, "documents").select("doc_id", "text")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(DROPS))
    log = run_in_drops([docs.where(part == i) for i in range(DROPS)],
                       lambda s: ops.running_count(words(s, "text"), ["word"]),
                       None, "update", "wordcount", sinks.batch_log_writer)
    return sinks.latest_revision(log, ["word"])


@query("stream_sliding_count")
def q_stream_sliding_count(spark, sf):
    """Sliding counts in update mode with a watermark: state of closed windows
    is evicted from drop to drop, open windows are in the log as well."""
    log = run_in_drops(event_drops(spark, sf), _sliding, None, "update", "sliding", sinks.batch_log_writer)
    return _newest_windows(log)


def _sliding(stream):
    return ops.windowed_count(ops.event_time(stream, "ts"), "ts", ["event_type"],
                              "10 minutes", "5 minutes", watermark="10 minutes")


def _newest_windows(log):
    return sinks.latest_revision(log, ["window_start", "event_type"]).withColumns(
        ntz("window_start", "window_end"))


def _last_result(log):
    """Complete mode: every batch writes the whole result; the last one holds."""
    last = log.agg(F.max("batch_id").alias("last"))
    return log.join(F.broadcast(last), F.col("batch_id") == F.col("last")).drop("batch_id", "last")


@query("stream_sliding_complete")
def q_stream_sliding_complete(spark, sf):
    """Sliding counts in complete mode, ordered by window."""
    log = run_in_drops(
        event_drops(spark, sf),
        lambda s: ops.windowed_count(ops.event_time(s, "ts"), "ts", ["event_type"], "10 minutes",
                                     "5 minutes").orderBy("window_start"),
        None, "complete", "slidingall", sinks.batch_log_writer)
    return _last_result(log).withColumns(ntz("window_start", "window_end"))


@query("stream_tumbling_count")
def q_stream_tumbling_count(spark, sf):
    log = run_in_drops(
        event_drops(spark, sf),
        lambda s: ops.windowed_count(ops.event_time(s, "ts"), "ts", ["event_type"], "1 hour")
        .orderBy("window_start"), None, "complete", "tumbling", sinks.batch_log_writer)
    return _last_result(log).withColumns(ntz("window_start", "window_end"))


@query("stream_dedup")
def q_stream_dedup(spark, sf):
    return run_in_drops(
        event_drops(spark, sf),
        lambda s: ops.dedup(s, ["user_id", "event_type"]).select("user_id", "event_type"),
        "parquet", "append", "dedup")


@query("stream_dedup_watermark")
def q_stream_dedup_watermark(spark, sf):
    """A tenth of the events is delivered twice; each counts once."""
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts")
    twice = ev.unionByName(ev.where("event_id % 10 = 0"))
    out = run_in_drops(
        time_drops(twice, "ts"),
        lambda s: ops.dedup_with_watermark(ops.event_time(s, "ts"), "ts", "10 minutes", ["user_id"])
        .select("user_id", "ts"), "parquet", "append", "dedupwm")
    return out.withColumns(ntz("ts"))


def _views_clicks(ev):
    views = ev.where("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("view_user"),
        F.col("ts").alias("view_ts"))
    clicks = ev.where("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"),
        F.col("ts").alias("click_ts"))
    return views, clicks


@query("stream_interval_join")
def q_stream_interval_join(spark, sf):
    return run_in_drops(event_drops(spark, sf), lambda s: _view_click_join(s, "inner"),
                        "parquet", "append", "ijoin")


def _view_click_join(stream, how):
    views, clicks = _views_clicks(ops.event_time(stream, "ts"))
    j = ops.interval_join(views, clicks, "view_user", "click_user", "view_ts", "click_ts",
                          "2 hours", "3 hours", "1 hour", how=how)
    return j.select("view_id", "click_id", F.col("view_user").alias("user_id"))


@query("stream_interval_left_join")
def q_stream_interval_left_join(spark, sf):
    """Left outer: unmatched views are emitted when the watermark passes
    them, so one far-future sentinel row per side arrives last and is
    filtered from the output."""
    schema = load(spark, sf, "events").schema
    sentinel = spark.createDataFrame(
        [(-1, SENTINEL_TS, -1, "view", 0.0, None), (-2, SENTINEL_TS, -2, "click", 0.0, None)],
        "event_id bigint, ts string, user_id bigint, event_type string, value double, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*schema.names)
    out = run_in_drops([*event_drops(spark, sf), sentinel],
                       lambda s: _view_click_join(s, "left_outer"), "parquet", "append", "iljoin")
    return out.where("view_id >= 0")


@query("stream_kafka_to_parquet")
def q_stream_kafka_to_parquet(spark, sf):
    """Kafka-shaped records replayed as files → parsed app log → parquet."""
    base = scratch_path(spark, "kafka-in")
    glob = stage_files([derived.kafka_records(spark, sf)], base)
    parsed = parse_app_log(file_stream(spark, glob, KAFKA_SCHEMA))
    sink, _ = run_available_now(parsed, "parquet", "append", "kafka")
    return read_sink(spark, sink, parsed.schema)


def _device_stream(spark, sf):
    return _devices(table_stream(spark, sf, "events"))


def _devices(stream):
    ev = ops.event_time(stream, "ts")
    return ev.select(F.col("user_id").cast("string").alias("device"),
                     F.col("event_type").alias("deviceType"),
                     F.col("value").alias("signal"), F.col("ts").alias("time"))


@query("stream_filter")
def q_stream_filter(spark, sf):
    d = _device_stream(spark, sf).where("signal > 10").select("device", "signal")
    sink, _ = run_available_now(d, "parquet", "append", "filter")
    return read_sink(spark, sink, d.schema)


@query("stream_group_count")
def q_stream_group_count(spark, sf):
    log = run_in_drops(event_drops(spark, sf),
                       lambda s: ops.running_count(_devices(s), ["deviceType"]),
                       None, "update", "groupcount", sinks.batch_log_writer)
    return sinks.latest_revision(log, ["deviceType"])


@query("stream_device_avg")
def q_stream_device_avg(spark, sf):
    log = run_in_drops(event_drops(spark, sf),
                       lambda s: _devices(s).groupBy("deviceType").agg(F.round(F.avg("signal"), 6).alias("avg_signal")),
                       None, "complete", "deviceavg", sinks.batch_log_writer)
    return sinks.latest_revision(log, ["deviceType"])


@query("stream_global_count")
def q_stream_global_count(spark, sf):
    """SQL over a streaming temp view."""
    view = f"updates_{scratch_path(spark, 'v').rsplit('-', 1)[-1]}"

    def count(stream):
        ops.event_time(stream, "ts").createOrReplaceTempView(view)
        return spark.sql(f"SELECT count(*) AS n FROM {view}")

    log = run_in_drops(event_drops(spark, sf), count, None, "complete", "globalcount", sinks.batch_log_writer)
    spark.catalog.dropTempView(view)
    return log.agg(F.max_by("n", "batch_id").alias("n"))


def _run_ledger(spark, sf):
    """Records arrive in three drops; after each drop the ledger query
    restarts from its checkpoint, so every drop is its own micro-batch.
    Returns the ledger log (one folder per batch id)."""
    rec = derived.kafka_records(spark, sf).withColumn("value", F.col("value").cast("string"))
    drops = time_drops(rec, "timestamp")
    inbox = scratch_path(spark, "ledger-in")
    base = scratch_path(spark, "ledger")
    sink = None
    for i, drop in enumerate(drops):
        drop.write.parquet(f"{inbox}/d{i}")
        stream = file_stream(spark, f"{inbox}/d*", rec.schema)
        sink, _ = run_available_now(stream, None, "append", "ledger", base=base,
                                    foreach_batch=lambda p: sinks.offset_ledger_writer(p))
    schema = off.offset_snapshot(rec).withColumn("batch_id", F.lit(0)).schema
    return read_sink(spark, sink, schema), rec


@query("stream_at_least_once")
def q_stream_at_least_once(spark, sf):
    """The offsets each micro-batch starts from are recorded before it is
    processed, so a consumer that resumes from the ledger replays it."""
    processed = scratch_path(spark, "processed")

    def process(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{processed}/batch_id={batch_id}")

    return run_in_drops(time_drops(derived.kafka_records(spark, sf), "timestamp"), lambda s: s, None, "append", "atleast",
                        lambda path: sinks.at_least_once_writer(path, process),
                        logged="topic string, partition int, from_offset bigint, batch_id int")


@query("stream_offset_ledger")
def q_stream_offset_ledger(spark, sf):
    """Per micro-batch, until-offset and newest payload of every partition
    saved together (foreachBatch); the committed ledger is read back."""
    ledger, _ = _run_ledger(spark, sf)
    return sinks.committed_offsets(ledger)


@query("stream_ledger_resume")
def q_stream_ledger_resume(spark, sf):
    """Full cycle: the streaming ledger is written, then the start offsets
    for a restarted consumer are resolved from it (new partitions from 0)
    and rendered as the Kafka source's startingOffsets JSON."""
    ledger, rec = _run_ledger(spark, sf)
    history = ledger.select("topic", F.lit(LEDGER_GROUP).alias("group_id"),
                            F.col("batch_id").cast("bigint").alias("batch_ms"),
                            F.col("partition").cast("int").alias("partition"), "until_offset")
    resolved = off.resolve_offsets(history, off.topic_partitions(rec), LEDGER_GROUP)
    return off.starting_offsets_json(resolved)


@query("stream_csv")
def q_stream_csv(spark, sf):
    """Events land as ';'-separated CSV files; a schema'd CSV file stream
    ingests them into parquet."""
    from lakeloom.sources import files
    from lakeloom.streaming.sources import csv_stream

    ev = load(spark, sf, "events")
    inbox = scratch_path(spark, "csv-in")
    files.write_csv(ev, f"{inbox}/d0", sep=";")
    s = csv_stream(spark, f"{inbox}/d*", ev.schema, sep=";", **files.EXACT_TS)
    sink, _ = run_available_now(s, "parquet", "append", "csvstream")
    return read_sink(spark, sink, ev.schema)


@query("stream_line_word_count")
def q_stream_line_word_count(spark, sf):
    """Line stream (the file stand-in for a socket): documents arrive as
    text files, in drops; words are counted with arrival timestamps attached."""
    from lakeloom.sources import files
    from lakeloom.streaming.sources import line_stream

    inbox = scratch_path(spark, "lines-in")
    base = scratch_path(spark, "linewc")
    docs = load(spark, sf, "documents")
    part = F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(DROPS))
    for i in range(DROPS):
        files.write_text(docs.where(part == i).select("text"), f"{inbox}/d{i}")
        lines = line_stream(spark, f"{inbox}/d*", with_arrival_time=True)
        counts = ops.running_count(ops.split_words(lines, "value"), ["word"])
        sink, _ = run_available_now(counts, None, "update", "linewc",
                                    foreach_batch=sinks.batch_log_writer, base=base)
    log = read_sink(spark, sink, T.StructType([*counts.schema.fields, T.StructField("batch_id", T.IntegerType())]))
    return sinks.latest_revision(log, ["word"])


@query("stream_parquet")
def q_stream_parquet(spark, sf):
    """Default-format (parquet) file stream with a given schema → parquet sink."""
    orders = table_stream(spark, sf, "orders")
    sink, _ = run_available_now(orders, "parquet", "append", "parquetstream")
    return read_sink(spark, sink, orders.schema)


@query("stream_watermark_count")
def q_stream_watermark_count(spark, sf):
    """Hourly windows with a 10-minute watermark in append mode: each window
    is written once, after it closes; the still-open last one is withheld."""
    out = run_in_drops(
        event_drops(spark, sf),
        lambda s: ops.windowed_count(ops.event_time(s, "ts"), "ts", ["event_type"], "1 hour",
                                     watermark="10 minutes"), "parquet", "append", "wmcount")
    return out.withColumns(ntz("window_start", "window_end"))


@query("stream_late_drop")
def q_stream_late_drop(spark, sf):
    """Late data: all events arrive in a first drop; a second drop repeats
    the first day's events after the watermark has passed them. They are
    dropped as late, so the sliding counts equal those of the events once."""
    ev = load(spark, sf, "events")
    first_day = ev.where(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    return _newest_windows(run_in_drops([ev, first_day], _sliding, None, "update", "late",
                                        sinks.batch_log_writer))
