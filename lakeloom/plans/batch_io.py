"""Registered connector round trips: data written under the shared
checkpoint root, read back and compared with the source table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import relational as rel
from lakeloom.operators.text import line_word_count
from lakeloom.plans.registry import query
from lakeloom.session import scratch_path
from lakeloom.sources import catalog, files
from lakeloom.tables import load


@query("scan_text")
def q_scan_text(spark, sf):
    """Documents written as text files, read back line by line, counted."""
    path = scratch_path(spark, "docs-text")
    files.write_text(load(spark, sf, "documents").select("text"), path)
    return line_word_count(files.read_text(spark, path), "value")


@query("scan_csv")
def q_scan_csv(spark, sf):
    ev = load(spark, sf, "events")
    path = scratch_path(spark, "events-csv")
    files.write_csv(ev, path, sep=";")
    return files.read_csv(spark, path, ev.schema, sep=";")


@query("roundtrip_json")
def q_roundtrip_json(spark, sf):
    ev = load(spark, sf, "events")
    path = scratch_path(spark, "events-json")
    files.write(ev, path, "json")
    return files.read(spark, path, "json", ev.schema)


@query("roundtrip_orc")
def q_roundtrip_orc(spark, sf):
    o = load(spark, sf, "orders")
    path = scratch_path(spark, "orders-orc")
    files.write(o, path, "orc")
    return files.read(spark, path, "orc")


@query("table_append_partitioned")
def q_table_append_partitioned(spark, sf):
    """Two appends into a catalog table partitioned by event type, all
    partitions read back."""
    location = scratch_path(spark, "events-table")
    name = "lakeloom_events_" + location.rsplit("-", 1)[-1]
    ev = load(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    for _ in range(2):
        catalog.append_partitioned(ev, name, ["event_type"], location)
    catalog.refresh(spark, name)
    return catalog.scan(spark, name).select("event_id", "user_id", "value", "event_type")


@query("union_append_partitioned")
def q_union_append_partitioned(spark, sf):
    """Many inputs, one plan: their union is appended to a partitioned table
    in a single write and read back."""
    location = scratch_path(spark, "union-table")
    name = "lakeloom_union_" + location.rsplit("-", 1)[-1]
    inputs = [("events", "event_id", "event_type", "event"), ("orders", "o_orderkey", "o_orderstatus", "order"),
              ("customer", "c_custkey", "c_mktsegment", "customer")]
    parts = [load(spark, sf, t).select(F.col(k).alias("event_id"), F.col(v).alias("label"), F.lit(kind).alias("kind"))
             for t, k, v, kind in inputs]
    catalog.append_partitioned(rel.union_many(parts), name, ["kind"], location)
    return catalog.scan(spark, name).select("event_id", "label", "kind")


@query("empty_with_schema")
def q_empty_with_schema(spark, sf):
    """A typed empty placeholder unions cleanly with real inputs."""
    o = load(spark, sf, "orders")
    return rel.union_many([rel.empty_with_schema(spark, o.schema), o])


def _orders_table(spark, sf):
    location = scratch_path(spark, "orders-table")
    name = "lakeloom_orders_" + location.rsplit("-", 1)[-1]
    catalog.save_table(load(spark, sf, "orders"), name, location=location)
    return name


@query("scan_table")
def q_scan_table(spark, sf):
    """A catalog table read by name and queried with SQL."""
    name = _orders_table(spark, sf)
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS max_key "
                     f"FROM {name} GROUP BY o_orderstatus")


@query("table_scan_pruned")
def q_table_scan_pruned(spark, sf):
    """Column list + WHERE predicate on a table: both reach the scan
    (ReadSchema has three columns, PushedFilters holds the predicate)."""
    t = catalog.scan(spark, _orders_table(spark, sf))
    return t.select("o_orderkey", "o_custkey", "o_orderpriority") \
        .where(F.col("o_orderpriority") == "1-URGENT")


@query("observed_metrics")
def q_observed_metrics(spark, sf):
    """Metrics collected on the side of a write (the accumulator pattern):
    rows and value in cents are observed while events are written, then
    returned as one row."""
    from pyspark.sql import Observation

    obs = Observation("events_written")
    ev = load(spark, sf, "events")
    observed = ev.observe(obs, F.count(F.lit(1)).alias("n"),
                          F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("value_cents"))
    observed.write.parquet(scratch_path(spark, "observed"))
    m = obs.get
    return spark.createDataFrame([(m["n"], m["value_cents"])], "n bigint, value_cents bigint")


@query("catalog_ops")
def q_catalog_ops(spark, sf):
    """DDL-created table, insert, refresh, existence and listing checks,
    then a grouped read of the table."""
    location = scratch_path(spark, "customer-ddl")
    name = "lakeloom_customer_" + location.rsplit("-", 1)[-1]
    catalog.create_table(spark, name, "c_custkey bigint, c_name string, c_mktsegment string",
                         location)
    load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment") \
        .write.insertInto(name)
    catalog.refresh(spark, name)
    listed = catalog.exists(spark, name) and name in catalog.list_tables(spark)
    return catalog.scan(spark, name).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.lit(listed).alias("listed"))
