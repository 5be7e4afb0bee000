"""Reshaping: JSON to rows and columns, wide ⇄ long, array projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.json import infer_object_schema, json_map, parse
from lakeloom.operators.relational import quoted


def explode_json_text(df: DataFrame, keys: Sequence[str], c: str, out: str = "element") -> DataFrame:
    """JSON array text → one row per element, each as its JSON text.

    The array is parsed, so brackets, commas and braces inside values or
    nested elements are no boundaries. An empty array, a null and a text that
    is no array give no row; a null element gives a null.
    """
    return df.select(*keys, F.explode(F.from_json(F.col(c), "array<string>")).alias(out))


def explode_json_marks(df: DataFrame, keys: Sequence[str], c: str, out: str = "element") -> DataFrame:
    """JSON array of flat objects → one row per element, cut at text marks.

    The text is not parsed: the outer brackets come off with a pattern, and the
    rest is split between ``}`` and ``{``. Only for arrays of flat objects whose
    values hold no ``},{``; ``explode_json_text`` takes any array. Null and
    empty arrays give no row.
    """
    inner = F.regexp_replace(F.trim(quoted(c)), r"^\[\s*|\s*\]$", "")
    marked = F.split(F.regexp_replace(inner, r"\}\s*,\s*\{", "}\n{"), "\n")
    return df.select(*keys, F.explode(marked).alias(out)).where(F.col(out) != "")


def field_by_marks(element: str | Column, name: str) -> Column:
    """A string field of a flat JSON object by the text between its marks
    (``substring_index`` from the left, then from the right); null without it."""
    e = F.col(element) if isinstance(element, str) else element
    mark = f'"{name}":"'
    return F.when(F.instr(e, mark) > 0, F.substring_index(F.substring_index(e, mark, -1), '"', 1))


def explode_json_array(df: DataFrame, keys: Sequence[str], c: str,
                       element: T.DataType | str) -> DataFrame:
    """JSON array text → one row per parsed element (robust form)."""
    arr = F.from_json(F.col(c), T.ArrayType(element) if isinstance(element, T.DataType)
                      else f"array<{element}>")
    return df.select(*keys, F.explode(arr).alias("e")).select(*keys, "e.*")


def elements_to_columns(df: DataFrame, keys: Sequence[str], c: str, schema: T.StructType,
                        prefix: str) -> DataFrame:
    """Each JSON element text → typed columns ``{prefix}_{field}``."""
    s = parse(c, schema)
    return df.select(*keys, *[s.getField(f.name).alias(f"{prefix}_{f.name}") for f in schema.fields])


def json_entries(df: DataFrame, keys: Sequence[str], c: str, drop: Sequence[str] = ()) -> DataFrame:
    """JSON object → one (key, value) row per entry, minus ``drop`` keys."""
    m = json_map(c)
    if drop:
        m = F.map_filter(m, lambda k, v: ~k.isin(*drop))
    return df.select(*keys, F.explode(m).alias("key", "value"))


def infer_and_parse(df: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """``spark.read.json`` over a string column: infer over all rows, then parse."""
    schema = infer_object_schema(df, c)
    return df.select(*keys, parse(c, schema).alias("_j")).select(*keys, "_j.*")


def flatten(df: DataFrame, struct_col: str, fields: Sequence[str], keep: Sequence[str] = (),
            as_json: Sequence[str] = ()) -> DataFrame:
    """Dotted-path projection of a struct; nested structs in ``as_json``
    become JSON text (stable across Spark versions, unlike a struct cast)."""
    cols = [quoted(k) for k in keep]
    cols += [F.col(f"{struct_col}.{f}").alias(f) for f in fields]
    cols += [F.to_json(F.col(f"{struct_col}.{f}")).alias(f) for f in as_json]
    return df.select(*cols)


def array_struct_project(arr: Column, fields: Sequence[str]) -> Column:
    """Keep some fields of every struct of an array (no Python UDF)."""
    return F.transform(arr, lambda e: F.struct(*[e.getField(f).alias(f) for f in fields]))


def rows_to_json(df: DataFrame, keys: Sequence[str] = (), name: str = "json") -> DataFrame:
    return df.select(*keys, F.to_json(F.struct(*[quoted(c) for c in df.columns])).alias(name))


def unpivot_cells(df: DataFrame, row_key: Column, family: str, value_cols: Sequence[str],
                  version: Column | None = None) -> DataFrame:
    """Wide rows → (row_key, family, qualifier, version, value) cells.

    One cell per non-null value; values become strings (cells are bytes).
    """
    base = df.select(row_key.alias("row_key"),
                     (version if version is not None else F.lit(0)).cast("bigint").alias("version"),
                     *[quoted(c).cast("string").alias(c) for c in value_cols])
    long = base.unpivot(["row_key", "version"], list(value_cols), "qualifier", "value")
    return long.where(F.col("value").isNotNull()).select(
        "row_key", F.lit(family).alias("family"), "qualifier", "version", "value")


def json_cells(df: DataFrame, row_key: Column, c: str, family: str,
               version: Column | None = None) -> DataFrame:
    """JSON objects → one cell per entry with a non-null value; nested values
    stay JSON text. A text that is no object has no cells."""
    at = version if version is not None else F.lit(0)
    long = df.select(row_key.alias("row_key"), at.cast("bigint").alias("version"),
                     F.explode(json_map(c)).alias("qualifier", "value"))
    return long.where(F.col("value").isNotNull()).select(
        "row_key", F.lit(family).alias("family"), "qualifier", "version", "value")


def sorted_cells(cells: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Cells globally ordered by (row_key, family, qualifier), as a sorted
    key-value file needs. Range partitioning spreads the sort over many
    tasks (never a single partition)."""
    keys = ["row_key", "family", "qualifier"]
    parts = (cells.repartitionByRange(num_partitions, *keys) if num_partitions
             else cells.repartitionByRange(*keys))
    return parts.sortWithinPartitions(*keys)
