"""Projection, renaming, casting, filtering, ordering and unions."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column by exact name, even when it contains dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in cols])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def cast_all(df: DataFrame, to: str = "string") -> DataFrame:
    """Cast every column in one projection (names kept, dotted names safe)."""
    return df.select(*[quoted(c).cast(to).alias(c) for c in df.columns])


def cast_all_to_string(df: DataFrame) -> DataFrame:
    return cast_all(df, "string")


def with_exprs(df: DataFrame, exprs: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus SQL-expression columns (``"num + 1"`` style)."""
    return df.select(*[quoted(c) for c in keep], *[F.expr(e).alias(n) for n, e in exprs.items()])


def where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """SQL-string or Column predicate; pushed into the scan when it can be."""
    return df.where(predicate)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def sort_limit(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top-k report: ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject,
    i.e. a per-partition top-k and one small merge — no global sort."""
    return df.orderBy(*order).limit(n)


def union_many(parts: Iterable[DataFrame], by_name: bool = False) -> DataFrame:
    """Union of many inputs as one plan; duplicates kept.

    Positional (``union``) by default; ``by_name`` aligns columns by name.
    Spark schedules all branches itself, no driver threads are needed.
    """
    parts = list(parts)
    if not parts:
        raise ValueError("union_many needs at least one input")
    step = (lambda a, b: a.unionByName(b)) if by_name else DataFrame.union
    return functools.reduce(step, parts)


def describe_schema(df: DataFrame) -> DataFrame:
    """(col_name, data_type, non_null) — schema plus a non-null count per
    column, computed in one aggregate pass and unpivoted."""
    counts = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    types = {f"c{i}": (c, f.dataType.simpleString()) for i, (c, f) in
             enumerate(zip(df.columns, df.schema.fields))}
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("col_name"), F.lit(t).alias("data_type"),
                 F.col(k).alias("non_null"))
        for k, (n, t) in types.items()
    ])).alias("s"))
    return stacked.select("s.*")


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """In-memory rows with an explicit schema (never inferred)."""
    return spark.createDataFrame(rows, schema)


def empty_with_schema(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """Typed empty relation — a usable placeholder that unions cleanly."""
    return spark.createDataFrame([], schema)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` as a reliable checkpoint in the shared
    ``spark.checkpoint.dir`` (survives executor loss, unlike a local
    checkpoint) and continue from it with a short plan."""
    from lakeloom.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def union_many_checkpointed(parts: Iterable[DataFrame], every: int = 64,
                            by_name: bool = False) -> DataFrame:
    """Union of very many inputs; every ``every`` inputs the partial union
    is checkpointed so the plan (and driver planning time) stays bounded."""
    acc: DataFrame | None = None
    for i, p in enumerate(parts, 1):
        acc = p if acc is None else union_many([acc, p], by_name)
        if i % every == 0:
            acc = cut_lineage(acc)
    if acc is None:
        raise ValueError("union_many_checkpointed needs at least one input")
    return acc


def with_min_partitions(df: DataFrame, n: int | None) -> DataFrame:
    """At least ``n`` partitions for CPU-heavy per-row work, like a text
    read with a minimum partition count: a round-robin repartition happens
    only when the input has fewer partitions (few large files); a large
    input already split into many partitions is left untouched. Call it on
    an input scan: counting partitions of a plan with shuffles would run them."""
    if not n:
        return df
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001  (no RDD view, e.g. a remote session)
        return df
    return df.repartition(n) if current < n else df
