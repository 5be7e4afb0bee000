"""Region-split bulk files of cells: one sorted file per region, and a manifest.

Regions are given by split keys, as a key-ordered store has them, and not by a
sample of the data: region ``i`` holds the row keys from split ``i - 1`` up to
split ``i``. Regions with too many cells are cut further at key prefixes, so a
hot region is written by several tasks. The manifest lists every file with its
keys; it is written only after a check that each file holds what its region may
hold and that the files follow each other in key order.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.kv import CELL_SCHEMA_DDL
from lakeloom.session import scratch_path

ORDER = ["row_key", "family", "qualifier", "version"]
MANIFEST = "region int, file string, lower string, upper string, first_key string, last_key string, cells bigint"


def _texts(values: Sequence[str]) -> Column:
    """A constant array; one literal, however many values."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def region_of(key: Column, splits: Sequence[str]) -> Column:
    """Number of the region of a row key; null keys have none. The splits
    ascend and are searched by halves."""
    steps = [F.lit(1 << k) for k in reversed(range(len(splits).bit_length()))]
    if not steps:
        return F.lit(0)
    held = _texts(splits)
    return F.aggregate(F.array(*steps), F.lit(0), lambda at, step: F.when(
        F.get(held, at + step - 1) <= key, at + step).otherwise(at))


def key_counts(cells: DataFrame) -> DataFrame:
    """Cells of every row key, counted once and kept in shared storage."""
    path = scratch_path(cells.sparkSession, "keycounts")
    cells.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    return cells.sparkSession.read.schema("row_key string, n bigint").parquet(path)


def hot_splits(counts: DataFrame, splits: Sequence[str], max_cells: int) -> list[str]:
    """``splits`` and further ones inside regions of more than ``max_cells``
    cells, at key prefixes; ``counts`` is what :func:`key_counts` gives. One
    key's cells are never parted. Each round counts the cells of what is still
    hot by one more character of the key: what reaches the driver is a count
    for each such prefix. What is hot are spans of keys apart from each other,
    so a key finds its own by halves."""
    key = F.col("row_key")
    figures = [F.sum("n").alias("n"), F.min("row_key").alias("a"), F.max("row_key").alias("b")]
    stem = lambda r: os.path.commonprefix([r.a, r.b])
    is_hot = lambda r: r.n > max_cells and r.a != r.b
    todo = counts.withColumn("region", region_of(key, splits)).groupBy("region").agg(*figures).where(F.col("n") > max_cells).collect()
    todo = [r for r in todo if is_hot(r)]
    found = set(splits)
    while todo:
        todo.sort(key=lambda r: r.a)
        at = counts.withColumn("i", region_of(key, [r.a for r in todo]) - 1)
        at = at.where((F.col("i") >= 0) & (key <= F.get(_texts([r.b for r in todo]), F.col("i"))))
        depth = F.get(_texts([str(len(stem(r)) + 1) for r in todo]), F.col("i")).cast("int")
        again, held, last = [], 0, None
        for r in at.groupBy("i", F.left(key, depth).alias("p")).agg(*figures).orderBy("i", "p").collect():
            if r.i != last:
                held, last = 0, r.i
            if held and held + r.n > max_cells:
                found.add(r.p)
                held = 0
            held += r.n
            if is_hot(r):
                again.append(r)
        todo = again
    return sorted(found)


def write(cells: DataFrame, path: str, splits: Sequence[str], max_cells: int | None = None) -> DataFrame:
    """Write ``cells`` under ``path``, one sorted Parquet file per region that
    has cells, and the manifest, which is returned. Cells without a row key have
    no region and raise. ``max_cells`` cuts hot regions further."""
    if list(splits) != sorted(set(splits)):
        raise ValueError("split keys must ascend")
    keys = key_counts(cells) if max_cells else cells
    if not keys.where("row_key IS NULL").isEmpty():
        raise ValueError("cells without a row key have no region")
    spark = cells.sparkSession
    cuts = hot_splits(keys, splits, max_cells) if max_cells else list(splits)
    placed = cells.withColumn("region", region_of(F.col("row_key"), cuts))
    placed = placed.repartitionById(len(cuts) + 1, F.col("region")).sortWithinPartitions("region", *ORDER)
    placed.write.partitionBy("region").parquet(f"{path}/cells")
    manifest = _manifest(spark, path, cuts).persist()  # a row for each file
    try:
        _check(manifest, cuts)
        manifest.write.parquet(f"{path}/manifest")
    finally:
        manifest.unpersist()
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _manifest(spark: SparkSession, path: str, cuts: Sequence[str]) -> DataFrame:
    from lakeloom.sources.files import path_kind

    schema = f"{CELL_SCHEMA_DDL}, region int"
    if path_kind(spark, f"{path}/cells") is None:
        return spark.createDataFrame([], MANIFEST)
    files = spark.read.schema(schema).parquet(f"{path}/cells").groupBy("region", F.input_file_name().alias("file")).agg(
        F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"), F.count(F.lit(1)).alias("cells"))
    bounds = _texts(cuts)
    return files.select("region", "file", F.get(bounds, F.col("region") - 1).alias("lower"),
                        F.get(bounds, F.col("region")).alias("upper"), "first_key", "last_key", "cells")


def _check(manifest: DataFrame, cuts: Sequence[str]) -> None:
    """One file a region, no file across a border, files in key order."""
    bad = manifest.where((F.col("first_key") < F.col("lower")) | (F.col("last_key") >= F.col("upper")))
    twice = manifest.groupBy("region").count().where("count > 1")
    if not bad.isEmpty() or not twice.isEmpty():
        raise ValueError("a region has several files, or a file crosses its region's border")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The cells back, with their region."""
    return spark.read.schema(f"{CELL_SCHEMA_DDL}, region int").parquet(f"{path}/cells")

