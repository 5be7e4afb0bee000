"""Streaming sources.

File streams stand in for sockets and brokers in tests (no ports are
opened); the Kafka source is an option preset for production clusters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None,
                **options: str) -> DataFrame:
    """Stream of files appearing under ``path`` (schema is required)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def csv_stream(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";",
               header: bool = False, **options: str) -> DataFrame:
    return file_stream(spark, path, schema, "csv", sep=sep, header=str(header).lower(), **options)


def line_stream(spark: SparkSession, path: str, with_arrival_time: bool = False) -> DataFrame:
    """Text lines (``value``), optionally with an arrival ``timestamp`` —
    the file-based stand-in for a socket source with includeTimestamp."""
    df = spark.readStream.format("text").load(path)
    return df.withColumn("timestamp", F.current_timestamp()) if with_arrival_time else df


def kafka_source_options(brokers: str, topic: str | None = None,
                         assign_json: str | None = None, starting_offsets: str = "latest",
                         **options: str) -> dict[str, str]:
    """Options for the Kafka source: ``subscribe`` a topic at
    ``starting_offsets``, or ``assign`` the partitions of a
    ``startingOffsets`` JSON from the offset ledger. Consumer properties are
    given with underscores for dots (``group_id``) and get their ``kafka.``
    prefix."""
    import json

    opts = {"kafka.bootstrap.servers": brokers}
    if assign_json:
        parts = {t: sorted(int(p) for p in ps) for t, ps in json.loads(assign_json).items()}
        opts.update({"assign": json.dumps(parts), "startingOffsets": assign_json})
    elif topic:
        opts.update({"subscribe": topic, "startingOffsets": starting_offsets})
    else:
        raise ValueError("give a topic or an assign JSON")
    source_keys = {k.lower() for k in KAFKA_SOURCE_KEYS}  # options are case-insensitive
    for k, v in options.items():
        known = k.startswith("kafka.") or k.lower() in source_keys
        opts[k if known else f"kafka.{k.replace('_', '.')}"] = v
    return opts


def kafka_stream(spark: SparkSession, brokers: str, topic: str | None = None,
                 assign_json: str | None = None, starting_offsets: str = "latest",
                 **options: str) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package on the cluster;
    absent here, so untested)."""
    opts = kafka_source_options(brokers, topic, assign_json, starting_offsets, **options)
    return spark.readStream.format("kafka").options(**opts).load()


# Source options of the Kafka source (everything else is a consumer
# property and gets the "kafka." prefix).
KAFKA_SOURCE_KEYS = {
    "assign", "subscribe", "subscribePattern", "startingOffsets", "endingOffsets",
    "startingOffsetsByTimestamp", "endingOffsetsByTimestamp", "startingTimestamp",
    "endingTimestamp", "startingOffsetsByTimestampStrategy", "failOnDataLoss",
    "kafkaConsumer.pollTimeoutMs", "fetchOffset.numRetries", "fetchOffset.retryIntervalMs",
    "maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay", "minPartitions",
    "maxRecordsPerPartition", "groupIdPrefix", "includeHeaders",
}
