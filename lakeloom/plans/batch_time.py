"""Registered calendar, event-time window and interval/range join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.dates import previous_month
from lakeloom.operators import joins, timeseries
from lakeloom.plans import derived
from lakeloom.plans.registry import query
from lakeloom.tables import load


@query("previous_month")
def q_previous_month(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", previous_month("o_orderdate").alias("prev_month"))


@query("month_spine")
def q_month_spine(spark, sf):
    o = load(spark, sf, "orders").agg(F.max("o_orderdate").alias("anchor"))
    return timeseries.month_spine(o, "anchor", 48)


@query("monthly_counts_filled")
def q_monthly_counts_filled(spark, sf):
    return timeseries.monthly_counts_filled(load(spark, sf, "orders"), "o_orderdate", 48)


@query("sliding_count")
def q_sliding_count(spark, sf):
    return timeseries.windowed_count(load(spark, sf, "events"), "ts", ["event_type"],
                                     "10 minutes", "5 minutes")


@query("tumbling_count")
def q_tumbling_count(spark, sf):
    return timeseries.windowed_count(load(spark, sf, "events"), "ts", ["event_type"], "1 hour")


def _views_clicks(spark, sf):
    ev = load(spark, sf, "events")
    views = ev.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts"))
    clicks = ev.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    return views, clicks


@query("interval_join")
def q_interval_join(spark, sf):
    views, clicks = _views_clicks(spark, sf)
    j = joins.interval_join(views, clicks, "user_id", "view_ts", "click_ts", 0, 3600)
    return j.select("view_id", "click_id", "user_id")


@query("interval_left_join")
def q_interval_left_join(spark, sf):
    views, clicks = _views_clicks(spark, sf)
    j = joins.interval_join(views, clicks, "user_id", "view_ts", "click_ts", 0, 3600, "left")
    return j.select("view_id", "click_id", "user_id")


@query("ip_range_join")
def q_ip_range_join(spark, sf):
    ev = load(spark, sf, "events").select("event_id", derived.ip_long().alias("ip_num"))
    pts = ev.select("event_id", joins.long_to_ip("ip_num").alias("ip"))
    pts = pts.withColumn("ip_num", joins.ip_to_long("ip"))
    out = joins.range_join(pts, derived.geo_ranges(spark, sf), "ip_num", "lo", "hi",
                           bucket_bits=24)
    return out.select("event_id", "ip", "country", "region")


@query("ip_visitors_bitmap")
def q_ip_visitors_bitmap(spark, sf):
    """Distinct visitor IPs per day. Addresses are sparse in 32 bits, so each
    (day, address) is made distinct and counted: a bitmap for every occupied
    bucket would be many times the addresses' size (``bitmap_distinct`` is
    the form for dense ids)."""
    from lakeloom.operators.aggregate import distinct_count

    ev = load(spark, sf, "events")
    visits = ev.select(F.to_date("ts").alias("day"),
                       joins.ip_to_long(joins.long_to_ip(derived.ip_long())).alias("ip_num"))
    return distinct_count(visits, ["day"], "ip_num", "visitors")
