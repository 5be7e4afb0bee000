"""Event-time bucketing on batch data (same windows as the streaming jobs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.dates import month_offsets


# Month and year lengths are nominal: they only order and validate durations.
_UNIT_SECONDS = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60,
                 "hour": 3600, "day": 86400, "week": 604800, "month": 2_592_000,
                 "year": 31_536_000}


def duration_seconds(text: str) -> float:
    """Seconds in an interval string such as ``"1 minute 30 seconds"``."""
    words = text.lower().replace("interval", "").split()
    if not words or len(words) % 2:
        raise ValueError(f"cannot parse duration {text!r}")
    total = 0.0
    for n, unit in zip(words[::2], words[1::2]):
        unit = unit.rstrip("s")
        if unit not in _UNIT_SECONDS:
            raise ValueError(f"unknown unit in duration {text!r}")
        total += float(n) * _UNIT_SECONDS[unit]
    return total


def check_window(window: str, slide: str | None) -> None:
    """Slide must be positive and no longer than the window."""
    if slide is not None and not (0 < duration_seconds(slide) <= duration_seconds(window)):
        raise ValueError(f"slide {slide!r} must be > 0 and <= window {window!r}")


def windowed_count(df: DataFrame, ts: str, keys: Sequence[str], window: str,
                   slide: str | None = None, name: str = "cnt") -> DataFrame:
    """Rows per (window, keys); tumbling when ``slide`` is None.

    Each row is expanded to the windows it falls in, then counted with
    partial aggregation. Output columns ``window_start``, ``window_end``.
    """
    check_window(window, slide)
    w = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    return (df.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(name))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, name))


def month_spine(anchor_df: DataFrame, anchor_col: str, n: int = 48) -> DataFrame:
    """``n + 1`` months (``yyyy-MM``) ending at the anchor's month."""
    return anchor_df.select(F.explode(month_offsets(anchor_col, n)).alias("m")) \
        .select(F.date_format("m", "yyyy-MM").alias("month"))


def monthly_counts_filled(df: DataFrame, ts: str, n: int = 48, name: str = "cnt") -> DataFrame:
    """Rows per month over the last ``n + 1`` months up to the newest row,
    with 0 for empty months.

    One scan: the input is aggregated per month, the monthly counts (one
    entry per calendar month, a bounded set) are packed into a single map
    row with the newest month as anchor, and the calendar spine looks its
    counts up in that map.
    """
    month = F.trunc(F.col(ts).cast("date"), "MM")
    counts = (df.where(month.isNotNull()).groupBy(month.alias("m"))  # null time: no month
              .agg(F.count(F.lit(1)).alias("c")))
    packed = counts.agg(F.max("m").alias("anchor"),
                        F.map_from_entries(F.collect_list(F.struct("m", "c"))).alias("cm"))
    spine = packed.where(F.col("anchor").isNotNull()) \
        .select(F.explode(month_offsets("anchor", n)).alias("m"), "cm")
    return spine.select(F.date_format("m", "yyyy-MM").alias("month"),
                        F.coalesce(F.try_element_at("cm", F.col("m")), F.lit(0)).alias(name))
