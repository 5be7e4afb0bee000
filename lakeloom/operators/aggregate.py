"""Keyed and global aggregations.

All of them plan as partial HashAggregate → Exchange → final aggregate,
so a key holding a large share of the rows still sends only one partial
row per map task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakeloom.operators.relational import quoted


def money(c: str | Column, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal view of a binary-floating money column."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(f"decimal({precision},{scale})")


def sum_by_key(df: DataFrame, keys: Sequence[str], values: dict[str, Column],
               sort: bool = False) -> DataFrame:
    """``reduceByKey(_ + _)`` (optionally ``.sortByKey()``)."""
    out = df.groupBy(*keys).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    return out.orderBy(*keys) if sort else out


def count_by_group(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def set_by_key(df: DataFrame, key: Column, value: Column,
               key_name: str = "key", value_name: str = "vals") -> DataFrame:
    """Set of distinct values per key, sorted (combineByKey into a Set).

    The (key, value) pairs are first made distinct by a shuffle on both
    columns, so even a dominant key is spread over many tasks before its
    (already distinct) values are gathered.
    """
    pairs = df.select(key.alias(key_name), value.alias("_v")).distinct()
    return pairs.groupBy(key_name).agg(F.sort_array(F.collect_list("_v")).alias(value_name))


def set_by_key_rows(df: DataFrame, key: Column, value: Column,
                    key_name: str = "key", value_name: str = "val") -> DataFrame:
    """The same sets in long form, one (key, value) row per member — for
    value domains that grow with the data, where one array per key would
    put an unbounded set into a single row."""
    return df.select(key.alias(key_name), value.alias(value_name)).distinct()


def avg_all_numeric(df: DataFrame, keys: Sequence[str], prefix: str = "avg_") -> DataFrame:
    """``groupBy(keys).avg()`` over every numeric non-key column, renamed."""
    nums = [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in keys]
    return df.groupBy(*keys).agg(*[F.avg(quoted(c)).alias(prefix + c) for c in nums])


_SPEC_FUNCS = {
    "max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "mean": F.avg,
    "count": F.count, "first": F.first, "last": F.last,
}


def agg_by_spec(df: DataFrame, keys: Sequence[str], spec: dict[str, str]) -> DataFrame:
    """Map-style spec ``{"num": "max"}`` → column ``max_num``.

    ``count`` of a column ignores nulls (``count(age)`` of a null age is 0).
    """
    aggs = [_SPEC_FUNCS[fn](quoted(c)).alias(f"{fn}_{c}") for c, fn in spec.items()]
    return df.groupBy(*keys).agg(*aggs)


def distinct_count(df: DataFrame, keys: Sequence[str], value: str,
                   name: str = "n_distinct") -> DataFrame:
    """Exact distinct count of non-null values: (keys, value) pairs are made
    distinct, spread by value, then counted with partial aggregation, so a
    hot key is never gathered in one task."""
    pairs = df.where(quoted(value).isNotNull()).select(*[quoted(c) for c in (*keys, value)]).distinct()
    return pairs.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def bitmap_count_distinct(df: DataFrame, keys: Sequence[str], value: str,
                          name: str = "n_distinct") -> DataFrame:
    """Exact distinct count of an integral column with bitmaps, for dense ids.

    Values are split into fixed-size buckets; each bucket's bitmap is built
    with partial aggregation (OR of bitmaps), then bit counts are summed.
    Negative values are fine (they fall in negative bucket numbers).
    """
    v = F.col(value).cast("bigint")
    per_bucket = (
        df.where(v.isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(v).alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("_bm"))
    )
    return per_bucket.groupBy(*keys).agg(
        F.sum(F.bitmap_count("_bm")).cast("bigint").alias(name))


def bitmaps(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, ``bucket``, ``bitmap``: the distinct values of an integral column
    for each key as bitmaps of fixed size, to be stored and rolled up. Null
    values are in none."""
    v = F.col(value).cast("bigint")
    return df.where(v.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(v).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bitmap"))


def rolled_up(stored: DataFrame, keys: Sequence[Column], name: str = "n_distinct") -> DataFrame:
    """Distinct values for coarser ``keys`` from stored bitmaps: those of one
    bucket are joined by OR, then their bits are counted. No value is read again."""
    names = [f"_k{i}" for i in range(len(keys))]
    merged = stored.select(*[k.alias(n) for k, n in zip(keys, names)], "bucket", "bitmap").groupBy(*names, "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias(name))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             latest: bool = False) -> DataFrame:
    """One surviving row per key: earliest (or latest) by ``order``.

    ``min_by``/``max_by`` over a struct is a declarative aggregate, so it
    partially aggregates before the shuffle; a hot key is reduced map-side
    instead of being sorted in one task as a ``row_number`` window would be.
    ``order`` must make the choice unique (add a tie-break column).
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if latest else F.min_by
    row = F.struct(*[quoted(c) for c in rest])
    ordering = F.struct(*[quoted(c) for c in order])
    return (df.groupBy(*[quoted(k) for k in keys])
            .agg(pick(row, ordering).alias("_row"))
            .select(*[quoted(k) for k in keys], "_row.*"))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``dropDuplicates(keys)`` with a deterministic survivor."""
    return first_by(df, keys, order, latest=False).select(*df.columns)
