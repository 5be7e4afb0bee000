"""JSON expressions and distributed schema inference."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_map(c: str | Column) -> Column:
    """JSON object text → ``map<string,string>`` (nested values kept as text)."""
    return F.from_json(_col(c), "map<string,string>")


def sorted_keys(c: str | Column) -> Column:
    return F.array_sort(F.map_keys(json_map(c)))


def _variant_schema_to_ddl(schema: str) -> str:
    """Variant schema text → Spark DDL with ``spark.read.json`` typing:
    objects become structs, fractional decimals doubles, mixed values
    strings; null-only values stay VOID until the merge is done. Only type
    tokens are rewritten: back-quoted names are skipped and a token followed
    by ``:`` is a field name, not a type."""
    parts = schema.split("`")
    for i in range(0, len(parts), 2):  # outside back quotes
        seg = parts[i]
        seg = re.sub(r"\bOBJECT<", "STRUCT<", seg)
        seg = re.sub(r"\bVARIANT\b(?!\s*:)", "STRING", seg)
        seg = re.sub(r"\bDECIMAL\((\d+),\s*0\)(?!\s*:)", r"DECIMAL(\1,0)", seg)
        seg = re.sub(r"\bDECIMAL\(\d+,\s*[1-9]\d*\)(?!\s*:)", "DOUBLE", seg)
        parts[i] = seg
    return "`".join(parts)


def _finalize(t: T.DataType) -> T.DataType:
    """Null-only values (VOID) become strings, as ``spark.read.json`` does."""
    if isinstance(t, T.NullType):
        return T.StringType()
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _finalize(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_finalize(t.elementType))
    return t


def infer_object_schema(df: DataFrame, c: str, sample_fraction: float | None = None, seed: int = 42) -> T.StructType:
    """Schema of a column of JSON objects, inferred over *all* rows.

    One aggregate pass: every object is read into a VARIANT with the
    lenient JSON reader (single quotes accepted, value types kept — a quoted
    "007" stays a string) and ``schema_of_variant_agg`` merges the types of
    all rows with partial aggregation. Typing follows ``spark.read.json``:
    bigint and double widen to double, other mixes to string, null-only
    values become strings, nested objects structs; rows that are arrays,
    scalars or malformed carry no fields. Fields come out sorted.
    ``sample_fraction`` infers from a random sample (like ``samplingRatio``).
    Only the schema reaches the driver. Objects keyed by data (ids as keys)
    should be parsed as ``map<string,...>`` instead: every distinct key
    becomes a field here.
    """
    if sample_fraction is not None:
        df = df.sample(fraction=sample_fraction, seed=seed)
    is_object = F.ltrim(F.col(c)).startswith("{")  # arrays/scalars carry no fields
    v = F.when(is_object, F.from_json(F.col(c), "variant"))
    merged = df.agg(F.schema_of_variant_agg(v).alias("s")).first()["s"]
    if not merged or not merged.startswith("OBJECT<"):
        return T.StructType([])
    schema = _finalize(T.DataType.fromDDL(_variant_schema_to_ddl(merged)))
    return T.StructType(sorted(schema.fields, key=lambda f: f.name))


def parse(c: str | Column, schema: T.StructType | str) -> Column:
    """``from_json`` with an explicit schema; malformed text → all-null struct."""
    return F.from_json(_col(c), schema)
