"""Split scans: one table read as several scans, each row in exactly one.

A split is a condition that is true for its rows and false or null for all
others. ``prove`` counts, in one pass, under how many conditions each row falls;
a gap or an overlap raises before anything is read twice or lost.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.relational import quoted


def stride(column: str, lower: int, upper: int, n: int) -> list[Column]:
    """``n`` conditions on a numeric column. The bounds place the strides only:
    rows below the first, above the last and without a value are in the first
    and last split. Fewer conditions where there are fewer whole numbers."""
    if upper <= lower or n < 1:
        raise ValueError(f"no stride from {lower} to {upper} in {n}")
    n = min(n, upper - lower)
    c = quoted(column)
    if n == 1:
        return [F.lit(True)]
    cuts = [lower + (upper - lower) * k // n for k in range(1, n)]
    inner = [(c >= a) & (c < b) for a, b in zip(cuts, cuts[1:])]
    return [(c < cuts[0]) | c.isNull(), *inner, c >= cuts[-1]]


def by_predicates(predicates: Sequence[str]) -> list[Column]:
    """The conditions of a list of SQL predicates."""
    return [F.expr(p) for p in predicates]


def prove(df: DataFrame, splits: Sequence[Column]) -> None:
    """Raise if a row of ``df`` falls in no split or in several."""
    hits = functools.reduce(lambda a, b: a + b, [F.coalesce(s.cast("int"), F.lit(0)) for s in splits], F.lit(0))
    none, many = df.agg(F.count_if(hits == 0), F.count_if(hits > 1)).first()
    if none or many:
        raise ValueError(f"{none} rows are in no split, {many} in several")


def scan(df: DataFrame, splits: Sequence[Column], number: str = "split", proved: bool = False) -> DataFrame:
    """``df`` read as one scan per split, each with its condition pushed down,
    and the split's number. Proves the splits unless they are ``proved``, as
    those of ``stride`` are by construction."""
    if not proved:
        prove(df, splits)
    parts = [df.where(s).withColumn(number, F.lit(i)) for i, s in enumerate(splits)]
    return functools.reduce(DataFrame.unionAll, parts)
