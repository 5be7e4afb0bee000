"""Run a streaming job to completion over files (tests, registered checks).

Inputs are written as files under a fresh folder of the shared checkpoint
root; the query runs with ``availableNow`` (which also runs the trailing
no-data batch that advances watermarks) and its sink is read back.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeloom.session import scratch_path
from lakeloom.sources.files import path_kind
from lakeloom.streaming.sources import file_stream

# Progress of the last run per label (for plan/state reports).
LAST_PROGRESS: dict[str, list[dict]] = {}


def stage_files(batches: list[DataFrame], path: str, fmt: str = "parquet",
                pause_s: float = 0.0, single_file: bool = False, **options) -> str:
    """Write each frame to its own sub-folder ``b00000``, ``b00001``, ...
    and return the glob a file stream should watch.

    Frames are written in parallel (one file per task). ``single_file``
    (small test fixtures only) writes one file per frame, so that with
    ``maxFilesPerTrigger=1`` each frame is exactly one micro-batch; the
    source orders files by modification time, hence the optional pause.
    """
    for i, b in enumerate(batches):
        if i and pause_s:
            time.sleep(pause_s)
        (b.coalesce(1) if single_file else b).write.format(fmt).options(**options) \
            .save(f"{path}/b{i:05d}")
    return f"{path}/b*"


def run_in_drops(drops: list[DataFrame], build, fmt: str | None, output_mode: str, label: str,
                 foreach_batch=None, logged: str | None = None) -> DataFrame:
    """Let ``drops`` arrive one after the other: each is written to the inbox
    as parquet, then the query runs on from its checkpoint, so every drop is
    a micro-batch of its own (state carried over, revisions, eviction by
    watermark). ``build`` maps the file stream to the result stream; the sink
    is read back, an empty one with the result's columns (``logged``: those
    that ``foreach_batch`` writes, where they differ)."""
    spark = drops[0].sparkSession
    inbox, base = scratch_path(spark, f"{label}-in"), scratch_path(spark, label)
    sink, out = None, None
    for i, drop in enumerate(drops):
        drop.write.parquet(f"{inbox}/d{i:05d}")
        out = build(file_stream(spark, f"{inbox}/d*", drop.schema))
        sink, _ = run_available_now(out, fmt, output_mode, label, foreach_batch, base=base)
    schema = out.schema if foreach_batch is None else T.StructType([*out.schema.fields, T.StructField("batch_id", T.IntegerType())])
    return read_sink(spark, sink, T._parse_datatype_string(logged) if logged else schema)


def read_sink(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A sink read back; no row if no batch has written to it."""
    if path_kind(spark, path) is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def run_available_now(stream: DataFrame, fmt: str | None, output_mode: str, label: str,
                      foreach_batch=None, timeout_s: int | None = None,
                      base: str | None = None) -> tuple[str, object]:
    """Start, wait for completion, return (sink path, query).

    Waits as long as the data takes; a limit is the caller's to set.

    Passing the same ``base`` again restarts the query from its checkpoint:
    only files that arrived since the last run are processed.
    """
    spark: SparkSession = stream.sparkSession
    base = base or scratch_path(spark, label)
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch(sink))
    else:
        w = w.format(fmt).option("path", sink)
    q = w.trigger(availableNow=True).start()
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {label} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    LAST_PROGRESS[label] = list(q.recentProgress)
    return sink, q


def run_side_by_side(rounds: list[tuple[DataFrame | None, DataFrame | None]], build, output_mode: str, label: str,
                     policy: str = "min", after_round=None) -> DataFrame:
    """Two independent file streams that move at their own speeds. In each
    round a side's drop arrives, or none, and the query runs on from its
    checkpoint. ``build`` maps the two streams to the result; ``policy``
    (``min`` or ``max``) makes one watermark of theirs; ``after_round(i, sink
    frame)`` sees what has been written so far."""
    from lakeloom.streaming.recovery import session_conf

    samples = [next(r[k] for r in rounds if r[k] is not None) for k in (0, 1)]
    spark = samples[0].sparkSession
    inboxes = [scratch_path(spark, f"{label}-in{k}") for k in (0, 1)]
    base, sink, out = scratch_path(spark, label), None, None
    for inbox, sample in zip(inboxes, samples):
        sample.limit(0).write.parquet(f"{inbox}/d_none")
    with session_conf(spark, {"spark.sql.streaming.multipleWatermarkPolicy": policy}):
        for i, sides in enumerate(rounds):
            for inbox, drop in zip(inboxes, sides):
                if drop is not None:
                    drop.write.parquet(f"{inbox}/d{i:05d}")
            out = build(*[file_stream(spark, f"{inbox}/d*", s.schema) for inbox, s in zip(inboxes, samples)])
            sink, _ = run_available_now(out, "parquet", output_mode, label, base=base)
            if after_round is not None:
                after_round(i, read_sink(spark, sink, out.schema))
    return read_sink(spark, sink, out.schema)


def run_while_arriving(drops: list[DataFrame], build, output_mode: str, label: str, foreach_batch,
                       processing_time: str = "200 milliseconds") -> DataFrame:
    """One query that stays up on a processing-time trigger while ``drops``
    arrive; it is stopped once everything is processed. The sink that
    ``foreach_batch`` writes is read back."""
    spark = drops[0].sparkSession
    inbox, base = scratch_path(spark, f"{label}-in"), scratch_path(spark, label)
    sink = f"{base}/sink"
    drops[0].limit(0).write.parquet(f"{inbox}/d_none")
    out = build(file_stream(spark, f"{inbox}/d*", drops[0].schema))
    query = (out.writeStream.outputMode(output_mode).option("checkpointLocation", f"{base}/checkpoint")
             .foreachBatch(foreach_batch(sink)).trigger(processingTime=processing_time).start())
    try:
        for i, drop in enumerate(drops):
            drop.write.parquet(f"{inbox}/d{i:05d}")
            query.processAllAvailable()
        LAST_PROGRESS[label] = list(query.recentProgress)
    finally:
        query.stop()
    return read_sink(spark, sink, T.StructType([*out.schema.fields, T.StructField("batch_id", T.IntegerType())]))
