"""Registered key-value (cell table) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import kv
from lakeloom.plans import derived
from lakeloom.plans.registry import query
from lakeloom.session import scratch_path
from lakeloom.tables import load

INFO = ["name", "nation", "segment", "acctbal_cents"]
TYPES = {"nation": "int", "acctbal_cents": "bigint", "last_order": "bigint"}


def _rows(cells):
    """Both families side by side; a row key with one family only stays."""
    info = kv.cells_to_rows(cells, "info", INFO, TYPES)
    orders = kv.cells_to_rows(cells, "orders", ["last_order", "last_status"], TYPES)
    return info.join(orders, "row_key", "full")


@query("cells_to_rows")
def q_cells_to_rows(spark, sf):
    return _rows(derived.customer_cells(spark, sf))


@query("kv_range_scan")
def q_kv_range_scan(spark, sf):
    """The key range is filtered below the union, before cells are built."""
    cells = kv.range_scan(derived.customer_cells(spark, sf), derived.key_text(100),
                          derived.key_text(600))
    return kv.cells_to_rows(cells, "info", INFO, TYPES).select("row_key", "name", "nation")


@query("kv_get")
def q_kv_get(spark, sf):
    return kv.latest_cells(kv.get(derived.customer_cells(spark, sf), derived.key_text(42)))


@query("kv_scan_family")
def q_kv_scan_family(spark, sf):
    return kv.latest_cells(kv.scan_family(derived.customer_cells(spark, sf), "orders"))


@query("kv_scan_concat")
def q_kv_scan_concat(spark, sf):
    return kv.concat_values(derived.customer_cells(spark, sf))


@query("latest_cell")
def q_latest_cell(spark, sf):
    return kv.latest_cells(derived.customer_cells(spark, sf))


@query("kv_put")
def q_kv_put(spark, sf):
    """Append a new version of ``segment`` for customers with a failed
    order, then read the newest segment."""
    cells = derived.customer_cells(spark, sf)
    o = load(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    new = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("v")).select(
        derived.row_key("o_custkey").alias("row_key"), F.lit("info").alias("family"),
        F.lit("segment").alias("qualifier"), (F.col("v") + 1).alias("version"),
        F.lit("HAS_F_ORDER").alias("value"))
    merged = kv.put(cells, new)
    return kv.cells_to_rows(merged, "info", ["segment"])


@query("kv_upsert")
def q_kv_upsert(spark, sf):
    """Overdrawn customers are replaced and suppliers inserted (as negative
    keys); the result is written to a new place and read back."""
    base = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    replaced = base.where(F.col("c_acctbal") < 0).select(
        "c_custkey", "c_name", F.lit("OVERDRAWN").alias("c_mktsegment"),
        F.lit(0.0).alias("c_acctbal"))
    inserted = load(spark, sf, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.lit("SUPPLIER").alias("c_mktsegment"), F.col("s_acctbal").alias("c_acctbal"))
    path = scratch_path(spark, "upserted")
    kv.upsert(base, replaced.unionByName(inserted), ["c_custkey"], ["c_acctbal"]).write.parquet(path)
    return spark.read.parquet(path)


def _bucketed_cells(spark, sf, buckets: int | None = None):
    """Bucketed like a shuffle of the session, unless the caller says otherwise."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    location = scratch_path(spark, "cells-bucketed")
    name = "lakeloom_cells_" + location.rsplit("-", 1)[-1]
    kv.save_bucketed(derived.customer_cells(spark, sf), name, buckets, location)
    return spark.table(name)


@query("cells_to_rows_bucketed")
def q_cells_to_rows_bucketed(spark, sf):
    """Rows from a bucketed cell table: the pivots and their join need no
    shuffle, because the scan is already partitioned by row key."""
    return _rows(_bucketed_cells(spark, sf))


@query("kv_get_bucketed")
def q_kv_get_bucketed(spark, sf):
    """Point get on the bucketed table: only the key's bucket is read."""
    return kv.latest_cells(kv.get(_bucketed_cells(spark, sf), derived.key_text(42)))
