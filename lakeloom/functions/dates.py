"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def previous_month(d: str | Column, fmt: str = "yyyy-MM") -> Column:
    """Month before the month of ``d`` (exact; no fixed 30-day step)."""
    return F.date_format(F.add_months(F.trunc(_col(d).cast("date"), "MM"), -1), fmt)


def month_offsets(anchor: str | Column, n: int) -> Column:
    """Array of the ``n + 1`` month starts from ``anchor``'s month back ``n``."""
    start = F.trunc(_col(anchor).cast("date"), "MM")
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: F.add_months(start, -k))
