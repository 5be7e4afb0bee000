"""Streaming transformations: counts, windows, watermarks, dedup, joins.

They are ordinary DataFrame → DataFrame functions, so the same code runs
on a batch frame; the streaming engine keeps their state per key in the
state store and evicts it by watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import java_split
from lakeloom.operators.timeseries import check_window, duration_seconds


def watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """``withWatermark`` after checking that ``delay`` is a duration."""
    if duration_seconds(delay) < 0:
        raise ValueError(f"negative watermark delay {delay!r}")
    return df.withWatermark(ts, delay)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); with a UTC session
    the cast keeps the wall-clock value."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def split_words(lines: DataFrame, col: str = "value", keep: Sequence[str] = (),
                name: str = "word") -> DataFrame:
    return lines.select(*keep, F.explode(java_split(col)).alias(name))


def running_count(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """Unbounded running count (update/complete mode)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def windowed_count(df: DataFrame, ts: str, keys: Sequence[str], window: str,
                   slide: str | None = None, watermark: str | None = None,
                   name: str = "cnt") -> DataFrame:
    """Count per event-time window (tumbling when ``slide`` is None).

    With ``watermark`` the state of closed windows is dropped and append
    mode emits each window once, after it closes; rows later than the
    watermark are dropped.
    """
    check_window(window, slide)
    if watermark:
        df = watermarked(df, ts, watermark)
    w = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    return (df.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(name))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, name))


def dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First row per key; state grows with the number of keys."""
    return df.dropDuplicates(list(keys))


def dedup_with_watermark(df: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """Dedup on keys that include the event time; state older than the
    watermark is evicted."""
    return watermarked(df, ts, delay).dropDuplicates([*keys, ts] if ts not in keys else list(keys))


def dedup_within_watermark(df: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """Drop repeats of a key arriving within ``delay`` of the first one."""
    return watermarked(df, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def interval_join(left: DataFrame, right: DataFrame, key_left: str, key_right: str,
                  left_ts: str, right_ts: str, left_delay: str, right_delay: str,
                  upper: str, how: str = "inner") -> DataFrame:
    """``right.ts BETWEEN left.ts AND left.ts + upper`` on equal keys, both
    sides watermarked (the global watermark is the minimum). Left outer
    emits unmatched left rows once the watermark has passed them."""
    lw = watermarked(left, left_ts, left_delay)
    rw = watermarked(right, right_ts, right_delay)
    cond = F.expr(f"{key_right} = {key_left} AND {right_ts} >= {left_ts} "
                  f"AND {right_ts} <= {left_ts} + interval {upper}")
    return lw.join(rw, cond, how)
