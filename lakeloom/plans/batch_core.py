"""Registered relational queries over the input tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import phone_prefix, valid_mobile
from lakeloom.operators import aggregate as agg
from lakeloom.operators import relational as rel
from lakeloom.operators import text, windows
from lakeloom.operators.joins import broadcast_if_small
from lakeloom.plans import derived
from lakeloom.plans.registry import query
from lakeloom.session import default_parallelism
from lakeloom.tables import load


def as_double(c: Column) -> Column:
    return c.cast("double")


@query("word_count")
def q_word_count(spark: SparkSession, sf: str):
    return text.word_count(load(spark, sf, "documents"), "text",
                           min_partitions=default_parallelism(spark))


@query("conversation_word_count")
def q_conversation_word_count(spark: SparkSession, sf: str):
    return text.word_count(load(spark, sf, "conversations"), "text",
                           min_partitions=default_parallelism(spark))


@query("split_tokens")
def q_split_tokens(spark, sf):
    return text.split_tokens(load(spark, sf, "conversations"), ["conv_id", "turn"], "text",
                             {"comma": ",", "space": " ", "dash": "-"})


@query("explode_split")
def q_explode_split(spark, sf):
    return text.explode_split(load(spark, sf, "conversations"), ["conv_id", "turn"], "text", " ")


@query("sum_by_key")
def q_sum_by_key(spark, sf):
    li = load(spark, sf, "lineitem")
    out = agg.sum_by_key(li, ["l_suppkey"], {
        "sum_qty": agg.money("l_quantity"), "sum_price": agg.money("l_extendedprice")}, sort=True)
    return out.select("l_suppkey", as_double(F.col("sum_qty")).alias("sum_qty"),
                      as_double(F.col("sum_price")).alias("sum_price"))


@query("count_by_group")
def q_count_by_group(spark, sf):
    return agg.count_by_group(load(spark, sf, "events"), ["event_type"])


@query("global_count")
def q_global_count(spark, sf):
    return spark.sql("SELECT count(*) AS n FROM {t}", t=load(spark, sf, "events"))


@query("sql_over_view")
def q_sql_over_view(spark, sf):
    name = f"events_{uuid.uuid4().hex[:8]}"
    load(spark, sf, "events").createOrReplaceTempView(name)
    out = spark.sql(f"""
        SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users
        FROM {name} GROUP BY event_type""")
    spark.catalog.dropTempView(name)  # the plan is already analysed
    return out


@query("set_by_key")
def q_set_by_key(spark, sf):
    ev = load(spark, sf, "events")
    s = agg.set_by_key(ev, F.pmod("user_id", F.lit(10)), F.hour("ts"), "user_bucket", "hours")
    return s.select("user_bucket",
                    F.array_join(F.col("hours").cast("array<string>"), ",").alias("hours"))


@query("avg_all_numeric")
def q_avg_all_numeric(spark, sf):
    keys = ["l_returnflag", "l_linestatus"]
    out = agg.avg_all_numeric(load(spark, sf, "lineitem"), keys)
    return out.select(*keys, *[F.round(c, 6).alias(c) for c in out.columns if c not in keys])


@query("agg_by_spec")
def q_agg_by_spec(spark, sf):
    return agg.agg_by_spec(load(spark, sf, "lineitem"), ["l_returnflag"],
                           {"l_quantity": "max", "l_discount": "min", "l_tax": "count"})


@query("window_partition_total")
def q_window_partition_total(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type", "user_id")
    return windows.attach_group_totals(ev, ["event_type"], {
        "type_user_sum": F.sum("user_id"), "type_rows": F.count(F.lit(1))})


@query("top_n_per_group")
def q_top_n_per_group(spark, sf):
    counts = agg.count_by_group(load(spark, sf, "events"), ["event_type", "user_id"])
    return windows.top_n_per_group(counts, ["event_type"],
                                   [F.col("cnt").desc(), F.col("user_id").asc()], 2)


@query("sort_desc_limit")
def q_sort_desc_limit(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rel.sort_limit(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


# The five event types of the events table.
EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]


@query("union_many")
def q_union_many(spark, sf):
    """Five independently produced inputs with one positional shape
    (key bigint, label string, amount double), unioned in one plan."""
    parts = [
        load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"),
        load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice"),
        load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"),
        load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"),
        load(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice"),
    ]
    return rel.union_many(parts).toDF("key", "label", "amount")


@query("cast_all_to_string")
def q_cast_all_to_string(spark, sf):
    return rel.cast_all_to_string(load(spark, sf, "orders"))


@query("describe_schema")
def q_describe_schema(spark, sf):
    return rel.describe_schema(load(spark, sf, "events"))


@query("project_columns")
def q_project_columns(spark, sf):
    return rel.project(load(spark, sf, "orders"), ["o_orderkey", "o_orderstatus", "o_orderdate"])


@query("rename_columns")
def q_rename_columns(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return rel.rename(c, {"c_custkey": "custkey", "c_name": "name", "c_mktsegment": "segment"})


@query("arith_project")
def q_arith_project(spark, sf):
    return rel.with_exprs(load(spark, sf, "lineitem"), {
        "linenumber_plus_one": "l_linenumber + 1",
        "line_id": "l_orderkey * 10 + l_linenumber",
        "qty_div_10": "CAST(l_quantity AS BIGINT) div 10",
    }, keep=["l_orderkey"])


@query("filter_even")
def q_filter_even(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return rel.where(li, "l_linenumber % 2 = 0")


@query("filter_expr")
def q_filter_expr(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return rel.where(li, "l_quantity > 25 AND l_discount <= 0.05")


@query("filter_compare")
def q_filter_compare(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rel.where(o, F.col("o_totalprice") < 5000)


@query("drop_null_rows")
def q_drop_null_rows(spark, sf):
    """One segment's customers have no segment here and customers without
    orders no count: both kinds of null go."""
    cust = load(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    per_cust = agg.count_by_group(load(spark, sf, "orders"), ["o_custkey"], "n_orders")
    joined = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
    return rel.drop_null_rows(joined.select("c_custkey", "c_mktsegment", "n_orders"))


@query("device_signal_filter")
def q_device_signal_filter(spark, sf):
    ev = load(spark, sf, "events")
    return ev.where("value > 10").select(F.col("user_id").alias("device"), "event_id")


@query("device_avg")
def q_device_avg(spark, sf):
    ev = load(spark, sf, "events")
    return ev.groupBy(F.col("event_type").alias("device_type")).agg(
        F.round(F.avg("value"), 6).alias("avg_signal"))


@query("scan_parquet")
def q_scan_parquet(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")


@query("literal_rows")
def q_literal_rows(spark, sf):
    weights = rel.literal_rows(spark, [(t, i + 1) for i, t in enumerate(EVENT_TYPES)],
                               "event_type string, weight int")
    counts = agg.count_by_group(load(spark, sf, "events"), ["event_type"], "n")
    out = counts.join(F.broadcast(weights), "event_type")  # 5 literal rows
    return out.select("event_type", "weight", "n", (F.col("n") * F.col("weight")).alias("weighted"))


@query("bitmap_distinct")
def q_bitmap_distinct(spark, sf):
    return agg.bitmap_count_distinct(load(spark, sf, "events"), ["event_type"], "user_id", "n_users")


@query("dedup_keep_first")
def q_dedup_keep_first(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return agg.dedup_keep_first(ev, ["user_id", "event_type"], ["ts", "event_id"])


@query("valid_mobile")
def q_valid_mobile(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", derived.phone().alias("phone"))
    return c.select("c_custkey", "phone", valid_mobile("phone").alias("is_valid"))


@query("phone_prefix")
def q_phone_prefix(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", derived.phone().alias("phone"))
    return c.select("c_custkey", phone_prefix("phone", 7).alias("prefix"))


@query("exact_decimal_sum")
def q_exact_decimal_sum(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.sum(agg.money("l_discount", 5, 2)).cast("string").alias("sum_discount"),
        (F.lit(1).cast("decimal(5,2)") * F.count(F.lit(1))
         - F.sum(agg.money("l_discount", 5, 2))).cast("string").alias("rest"))


@query("max_by_groups")
def q_max_by_groups(spark, sf):
    """Broadcast-checked lookup: nation names attached to customers."""
    nation = broadcast_if_small(load(spark, sf, "nation"), 10_000, materialize=False)
    c = load(spark, sf, "customer")
    return c.join(nation, c.c_nationkey == nation.n_nationkey).groupBy("n_name").agg(
        F.max_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("top_custkey"))
