"""Registered jobs that read or write by parts: split scans, region files, a
source with pushdown, a shipped lookup, stored bitmaps, arrays cut at marks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import aggregate, bulk, joins, kv, lookup, reshape, splits
from lakeloom.plans import derived
from lakeloom.plans.registry import query
from lakeloom.session import scratch_path
from lakeloom.sources import cells as cell_source
from lakeloom.streaming.recovery import session_conf
from lakeloom.tables import load

# Customer keys at which the regions of the cell files begin, and the
# region that covers all of a fifth of the addresses.
REGION_STARTS = (200, 500, 900, 1400)
FIFTH = 858993459


@query("stride_scan")
def q_stride_scan(spark, sf):
    """Orders read as ten scans by strides of the key; the bounds are rough."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return splits.scan(orders, splits.stride("o_orderkey", 1, 6000, 10), proved=True)


@query("predicate_scan")
def q_predicate_scan(spark, sf):
    """Events read as three scans by a list of time predicates, proven first."""
    ev = load(spark, sf, "events").select("event_id", "ts", "event_type")
    parts = splits.by_predicates([
        "ts < TIMESTAMP_NTZ '2024-01-10 00:00:00' OR ts IS NULL",
        "ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00' AND ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'",
        "ts >= TIMESTAMP_NTZ '2024-01-20 00:00:00'"])
    return splits.scan(ev, parts)


def _bulk(spark, sf):
    path = scratch_path(spark, "bulk")
    bulk.write(derived.customer_cells(spark, sf), path, [derived.key_text(k) for k in REGION_STARTS], max_cells=20_000)
    return path


@query("bulk_cells")
def q_bulk_cells(spark, sf):
    """Cells written as one sorted file per region, hot regions cut further, and read back."""
    return bulk.read(spark, _bulk(spark, sf)).drop("region")


@query("cell_source_range")
def q_cell_source_range(spark, sf):
    """A key range of the region files, read from the regions that it touches."""
    with session_conf(spark, cell_source.PUSHDOWN):
        found = kv.range_scan(cell_source.regions(spark, _bulk(spark, sf)), derived.key_text(100), derived.key_text(600))
        found._jdf.queryExecution().executedPlan()  # planned here, where the setting holds
        return found


def nested_ranges(spark, sf):
    """Address ranges of nations inside wide ones of regions."""
    r = load(spark, sf, "region")
    lo = F.col("r_regionkey").cast("bigint") * FIFTH
    wide = r.select(lo.alias("lo"), (lo + FIFTH - 1).alias("hi"), F.lit("?").alias("country"), F.col("r_name").alias("region"))
    return derived.geo_ranges(spark, sf).unionByName(wide)


@query("ip_lookup_shipped")
def q_ip_lookup_shipped(spark, sf):
    """Events' addresses looked up in nested ranges that every executor holds."""
    pts = load(spark, sf, "events").select("event_id", derived.ip_long().alias("ip_num"))
    out = lookup.shipped_lookup(pts, nested_ranges(spark, sf), "ip_num", "lo", "hi", ["country", "region"])
    return out.select("event_id", joins.long_to_ip("ip_num").alias("ip"), "country", "region")


@query("bitmap_rollup")
def q_bitmap_rollup(spark, sf):
    """Visitors per day, week and in all, from bitmaps stored by day."""
    path = scratch_path(spark, "bitmaps")
    ev = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    aggregate.bitmaps(ev, ["day"], "user_id").write.parquet(path)
    stored = spark.read.parquet(path)
    day = F.col("day").cast("timestamp_ntz")
    spans = (("day", F.col("day")), ("week", F.date_trunc("week", day).cast("date")),
             ("all", F.lit(None).cast("date")))
    parts = [aggregate.rolled_up(stored, [start], "visitors").select(F.lit(span).alias("span"), F.col("_k0").alias("start"), "visitors")
             for span, start in spans]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("explode_json_marks")
def q_explode_json_marks(spark, sf):
    """Contacts cut out of their JSON text by marks, without parsing."""
    rows = reshape.explode_json_marks(derived.contacts_json(spark, sf), ["c_custkey"], "contacts", "contact")
    return rows.select("c_custkey", reshape.field_by_marks("contact", "name").alias("name"),
                       reshape.field_by_marks("contact", "phone").alias("phone"),
                       F.substring_index(reshape.field_by_marks("contact", "name"), "#", 1).alias("kind"),
                       F.substring_index(reshape.field_by_marks("contact", "name"), "#", -1).alias("number"))
