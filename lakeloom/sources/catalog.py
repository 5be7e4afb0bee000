"""Catalog tables: create, append (partitioned), scan, list, refresh.

Works with the session's catalog — the in-memory one, or a Hive metastore
when the session was built with ``hive=True``. Tables get an explicit
location on shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", fmt: str = "parquet",
               partition_by: Sequence[str] | None = None, location: str | None = None) -> None:
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)


def append_partitioned(df: DataFrame, name: str, partition_by: Sequence[str],
                       location: str | None = None, fmt: str = "parquet") -> None:
    """Append to a partitioned table, creating it on first use."""
    exists = df.sparkSession.catalog.tableExists(name)
    save_table(df, name, "append", fmt, partition_by, None if exists else location)


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def refresh(spark: SparkSession, name: str) -> None:
    """Drop cached file listings/metadata after files changed underneath."""
    spark.catalog.refreshTable(name)


def create_table(spark: SparkSession, name: str, ddl_columns: str, location: str,
                 fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING {fmt}{part} "
              f"LOCATION '{location}'")
