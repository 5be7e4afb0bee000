"""Partitioned JDBC reads and parallel JDBC appends.

* stride read: ``partitionColumn``/``lowerBound``/``upperBound``/
  ``numPartitions``. The bounds only set the stride — they do not filter:
  the first partition also takes NULLs and smaller values, the last one
  everything above.
* predicate read: one partition per WHERE clause; rows matching no clause
  are not read and rows matching two are read twice, so clauses must
  cover the table exactly once (``half_open_ranges`` helps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Driver classes of the databases the jobs connect to.
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "oracle": "oracle.jdbc.OracleDriver",
    "hive": "org.apache.hive.jdbc.HiveDriver",
    "derby": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
    "postgresql": "org.postgresql.Driver",
}


def properties(user: str | None = None, password: str | None = None, driver: str | None = None,
               **extra: str) -> dict[str, str]:
    props = {k: v for k, v in {"user": user, "password": password}.items() if v is not None}
    if driver:
        props["driver"] = DRIVERS.get(driver, driver)
    props.update(extra)
    return props


def read_table(spark: SparkSession, url: str, table: str, props: dict[str, str]) -> DataFrame:
    """Whole table as one partition (small tables only)."""
    return spark.read.jdbc(url, table, properties=props)


def read_stride(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                num_partitions: int, props: dict[str, str], fetch_size: int = 10_000) -> DataFrame:
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions,
                           properties={**props, "fetchsize": str(fetch_size)})


def read_predicates(spark: SparkSession, url: str, table: str, predicates: Sequence[str],
                    props: dict[str, str]) -> DataFrame:
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)


def half_open_ranges(column: str, bounds: Sequence[str], include_null: bool = True,
                     open_ends: bool = True) -> list[str]:
    """Predicates ``column >= b[i] AND column < b[i+1]`` over consecutive
    bounds (SQL literals), plus ``< b[0]``, ``>= b[-1]`` and ``IS NULL`` so
    every row lands in exactly one partition."""
    preds = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    if open_ends and bounds:
        preds = [f"{column} < {bounds[0]}", *preds, f"{column} >= {bounds[-1]}"]
    if include_null:
        preds.append(f"{column} IS NULL")
    return preds


def append(df: DataFrame, url: str, table: str, props: dict[str, str],
           max_connections: int = 10, batch_size: int = 10_000) -> None:
    """Append with at most ``max_connections`` concurrent writers. A
    ``repartition`` (not ``coalesce``) caps the writers while the stages
    before it keep their full parallelism."""
    df.repartition(max_connections).write.mode("append").jdbc(
        url, table, properties={**props, "batchsize": str(batch_size)})
