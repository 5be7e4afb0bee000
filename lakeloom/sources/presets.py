"""Readers/writers for connectors whose packages are not installed here.

Each function only configures a DataFrameReader/Writer with the options
the connector documents; nothing is loaded until ``.load()``/``.save()``.
These paths are untested in this repository (no jars, no servers).
"""

from __future__ import annotations

from collections.abc import Sequence

# Fixed values below: format names and option keys are set by the connectors.
from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession


def avro_reader(spark: SparkSession) -> DataFrameReader:
    """Needs org.apache.spark:spark-avro on the classpath."""
    return spark.read.format("avro")


def avro_writer(df: DataFrame, mode: str = "errorifexists") -> DataFrameWriter:
    return df.write.format("avro").mode(mode)


def mongo_reader(spark: SparkSession, uri: str, database: str, collection: str,
                 read_preference: str = "secondaryPreferred") -> DataFrameReader:
    """MongoDB Spark connector (format ``mongodb``)."""
    return (spark.read.format("mongodb").option("connection.uri", uri)
            .option("database", database).option("collection", collection)
            .option("readPreference.name", read_preference))


def elasticsearch_reader(spark: SparkSession, nodes: str, resource: str,
                         **options: str) -> DataFrameReader:
    return (spark.read.format("org.elasticsearch.spark.sql").option("es.nodes", nodes)
            .option("es.resource", resource).options(**options))


def elasticsearch_writer(df: DataFrame, nodes: str, resource: str,
                         mode: str = "append") -> DataFrameWriter:
    return (df.write.format("org.elasticsearch.spark.sql").option("es.nodes", nodes)
            .option("es.resource", resource).mode(mode))


def phoenix_reader(spark: SparkSession, table: str, zk_url: str) -> DataFrameReader:
    return spark.read.format("phoenix").option("table", table).option("zkUrl", zk_url)


def phoenix_scan(spark: SparkSession, table: str, zk_url: str, columns: Sequence[str],
                 predicate: str | None = None) -> DataFrame:
    """Column list + WHERE clause, pushed down to the table by the source."""
    df = phoenix_reader(spark, table, zk_url).load().select(*columns)
    return df.where(predicate) if predicate else df


def phoenix_upsert(df: DataFrame, table: str, zk_url: str) -> DataFrameWriter:
    """The connector requires mode "overwrite"; rows are upserted by key,
    the table is not truncated."""
    return df.write.format("phoenix").mode("overwrite").option("table", table) \
        .option("zkUrl", zk_url)


def hbase_reader(spark: SparkSession, table: str, columns_mapping: str,
                 **options: str) -> DataFrameReader:
    """hbase-spark connector: ``hbase.columns.mapping`` like
    ``"row_key STRING :key, name STRING info:name"``."""
    return (spark.read.format("org.apache.hadoop.hbase.spark").option("hbase.table", table)
            .option("hbase.columns.mapping", columns_mapping).options(**options))


def kafka_writer(df: DataFrame, brokers: str, topic: str) -> DataFrameWriter:
    """Batch write of ``key``/``value`` columns to a Kafka topic."""
    return (df.write.format("kafka").option("kafka.bootstrap.servers", brokers)
            .option("topic", topic))
