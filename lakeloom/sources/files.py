"""File sources and sinks: parquet, ORC, CSV, JSON, text (Avro via preset).

Text formats cut timestamps to milliseconds by default; ``EXACT_TS``
keeps microseconds so a write/read round trip is lossless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EXACT_TS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
TEXT_FORMATS = {"csv", "json"}


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
          partition_by: Sequence[str] | None = None, num_files: int | None = None,
          **options: str) -> None:
    """Write ``df``; ``num_files`` lowers the file count with ``coalesce``
    (no shuffle) — keep it well above 1 for large data."""
    if num_files:
        df = df.coalesce(num_files)
    opts = {**(EXACT_TS if fmt in TEXT_FORMATS else {}), **options}
    w = df.write.format(fmt).mode(mode).options(**opts)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read(spark: SparkSession, path: str, fmt: str = "parquet",
         schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """Read files; text formats should be given a ``schema`` (inference is a
    full extra pass over the data)."""
    opts = {**(EXACT_TS if fmt in TEXT_FORMATS else {}), **options}
    r = spark.read.format(fmt).options(**opts)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";",
             header: bool = False) -> DataFrame:
    return read(spark, path, "csv", schema, sep=sep, header=str(header).lower())


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = False,
              mode: str = "errorifexists") -> None:
    write(df, path, "csv", mode, sep=sep, header=str(header).lower())


def read_text(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row (``value``) per line. ``min_partitions`` repartitions only
    when the files yield fewer partitions (large inputs are left as split)."""
    from lakeloom.operators.relational import with_min_partitions

    return with_min_partitions(spark.read.text(path), min_partitions)


def write_text(df: DataFrame, path: str, single_file: bool = False,
               mode: str = "errorifexists") -> None:
    """One line per row of the single string column. ``single_file`` funnels
    everything through one task — only for small outputs."""
    write(df, path, "text", mode, num_files=1 if single_file else None)


def path_kind(spark: SparkSession, path: str) -> str | None:
    """``file``, ``folder`` or None for a path of any file system, from its
    status alone (nothing is listed)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    return "folder" if fs.getFileStatus(p).isDirectory() else "file"
