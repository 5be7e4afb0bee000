"""Key-value tables stored as long "cells" (row_key, family, qualifier,
version, value): scans by key range, point gets, newest versions, row
assembly and upserts. Row keys compare as strings, i.e. in byte order for
ASCII keys, so a range ``[start, stop)`` is a pushed-down string filter.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.joins import broadcast_if_small
from lakeloom.operators.relational import quoted

CELL_KEY = ["row_key", "family", "qualifier"]


def range_scan(cells: DataFrame, start: str | None, stop: str | None) -> DataFrame:
    """Rows with ``start <= row_key < stop`` (either bound optional)."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("row_key") >= start)
    if stop is not None:
        cond = cond & (F.col("row_key") < stop)
    return cells.where(cond)


def get(cells: DataFrame, row_key: str) -> DataFrame:
    return cells.where(F.col("row_key") == row_key)


def scan_family(cells: DataFrame, family: str) -> DataFrame:
    return cells.where(F.col("family") == family)


def latest_cells(cells: DataFrame) -> DataFrame:
    """Newest version of every cell (partial aggregation, no sort); of values
    with the same version the greatest."""
    return cells.groupBy(*CELL_KEY).agg(
        F.max_by("value", F.struct("version", "value")).alias("value"), F.max("version").alias("version"))


def cells_to_rows(cells: DataFrame, family: str, qualifiers: Sequence[str],
                  types: dict[str, str] | None = None, key_name: str = "row_key") -> DataFrame:
    """Long cells → one wide row per key from the newest version of each
    qualifier. The qualifier list is given, so the pivot needs no extra
    distinct-values job; values are cast with ``try_cast`` (bad → null)."""
    types = types or {}
    wide = (scan_family(cells, family).groupBy("row_key")
            .pivot("qualifier", list(qualifiers)).agg(F.max_by("value", F.struct("version", "value"))))
    return wide.select(F.col("row_key").alias(key_name), *[
        (quoted(q).try_cast(types[q]) if q in types else quoted(q)).alias(q)
        for q in qualifiers])


def concat_values(cells: DataFrame, sep: str = "  ") -> DataFrame:
    """Per row key: newest values joined in (family, qualifier) order."""
    latest = latest_cells(cells)
    return latest.groupBy("row_key").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("family", "qualifier", "value"))),
        lambda e: e["value"]), sep).alias("values"))


def put(cells: DataFrame, new_cells: DataFrame) -> DataFrame:
    """Writes are appends of new versions; reads take the newest."""
    return cells.unionByName(new_cells)


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str],
           order: Sequence[str] = (), max_broadcast_keys: int = 5_000_000) -> DataFrame:
    """Insert-or-replace rows of ``target`` by ``keys``.

    ``changes`` is first reduced to one row per key: the newest by ``order``
    (``max_by`` with partial aggregation; equal orders, or none, by the other columns).
    A null key is a key like any other. The reduced change set is materialised once (checkpoint), its
    keys remove the replaced target rows with an anti join — broadcast when
    proven small, so the big target is never shuffled — and the changes are
    appended. Write the result to a new location and switch readers to it;
    never overwrite the input being read.
    """
    from lakeloom.operators.relational import cut_lineage

    cols = target.columns
    rest = [c for c in cols if c not in keys]
    changes = (changes.groupBy(*keys)
               .agg(F.max_by(F.struct(*[quoted(c) for c in rest]),
                             F.struct(*[quoted(c) for c in (*order, *rest)])).alias("_r"))
               .select(*keys, "_r.*"))
    changes = cut_lineage(changes.select(*cols))
    names = {k: f"_changed{i}" for i, k in enumerate(keys)}
    changed_keys = broadcast_if_small(changes.select(*keys).withColumnsRenamed(names),
                                      max_broadcast_keys, materialize=False)
    same = functools.reduce(operator.and_, [target[k].eqNullSafe(changed_keys[r]) for k, r in names.items()])
    kept = target.join(changed_keys, same, "left_anti")
    return kept.unionByName(changes)


def rows_as_map(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> Column:
    """Row as ``map<column name, value as string>``."""
    return F.create_map(*[x for c in cols for x in (F.lit(c), quoted(c).cast("string"))])


def write_table(cells: DataFrame, path: str, num_partitions: int | None = None,
                mode: str = "errorifexists") -> None:
    """Store cells as a key-ordered parquet table: range-partitioned on
    ``row_key`` and sorted within files, so each file and row group covers a
    narrow key range and ``get``/``range_scan`` filters skip the rest via
    parquet min/max statistics (the layout of a sorted key-value store)."""
    keys = ["row_key", "family", "qualifier", "version"]
    # Range bounds on the whole cell key keep the global order and let a row
    # key with very many cells span several partitions.
    parts = (cells.repartitionByRange(num_partitions, *keys) if num_partitions
             else cells.repartitionByRange(*keys))
    parts.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def read_table(spark, path: str) -> DataFrame:
    return spark.read.schema(CELL_SCHEMA_DDL).parquet(path)


CELL_SCHEMA_DDL = "row_key string, family string, qualifier string, version bigint, value string"


def save_bucketed(cells: DataFrame, name: str, num_buckets: int, location: str | None = None,
                  mode: str = "errorifexists") -> None:
    """Store cells as a catalog table bucketed and sorted by ``row_key``.

    Reads of the table are already hash-partitioned by ``row_key``, so
    grouping by key (rows from cells, newest versions) and joins on the key
    run without a shuffle, and an equality filter on ``row_key`` reads one
    bucket only. Choose ``num_buckets`` so a bucket file is ~256 MB-1 GB.
    The rows are first hash-partitioned on ``row_key`` into ``num_buckets``
    partitions (the same hash as bucketing), so each bucket is written by one
    task as one file instead of one file per writing task and bucket.
    """
    w = (cells.repartition(num_buckets, "row_key")
         .write.format("parquet").mode(mode).bucketBy(num_buckets, "row_key")
         .sortBy("row_key", "family", "qualifier", "version"))
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)
