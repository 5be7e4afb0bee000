"""Views derived from the input tables so every job reads real, scaling data:
Kafka-shaped records from ``events``, contact JSON and key-value cells from
``customer``/``orders``, IPv4 ranges from ``nation``/``region``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.joins import long_to_ip
from lakeloom.operators.reshape import unpivot_cells
from lakeloom.tables import load

# Topic name of the application-log stream and the column
# family of the contact cells.
TOPIC = "app_logs"
CONTACT_FAMILY = "cf"
N_PARTITIONS = 4
MICROS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
IP_MULT = 2654435761  # Knuth's multiplicative hash constant
NATION_SPAN = 171798692  # 2^32 / 25
RANGE_WIDTH = 150000000  # ranges leave gaps, so some addresses match nothing


def ip_long(user_id: str = "user_id") -> Column:
    """A 32-bit address of a user. The id is reduced first, so the product of
    any bigint id fits a bigint."""
    return F.pmod(F.pmod(F.col(user_id), F.lit(1 << 31)) * F.lit(IP_MULT), F.lit(4294967296))


def app_log(events: DataFrame) -> Column:
    ts = F.date_format("ts", MICROS_FMT)
    return F.struct(
        ts.alias("create_time"),
        F.col("user_id").cast("string").alias("user_uuid"),
        long_to_ip(ip_long()).alias("ip"),
        F.struct(F.col("event_type"), F.col("event_id").cast("string").alias("event_id"),
                 ts.alias("event_ts"),
                 F.round(F.col("value") * 100).cast("bigint").cast("string").alias("event_arg1"))
        .alias("events"))


def kafka_records(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as Kafka records: key = user, value = app-log JSON,
    partition = user_id mod 4, offset = event_id (increasing per partition,
    with gaps as in compacted or transactional topics)."""
    ev = load(spark, sf, "events")
    return ev.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(app_log(ev)).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod("user_id", F.lit(N_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"))


def phone(custkey: str = "c_custkey", nationkey: str = "c_nationkey", base: int = 30) -> Column:
    """Synthetic 11-digit mobile number: '1', base + nation, the key modulo
    10^8. A property of the customer, not an identity: several customers may
    share a number, so nothing is keyed by it (see :func:`row_key`)."""
    return F.concat(F.lit("1"), (F.col(nationkey) + base).cast("string"),
                    F.lpad(F.pmod(F.col(custkey), F.lit(100_000_000)).cast("string"), 8, "0"))


def contacts_json(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer a JSON array of two contacts (bounded per row)."""
    c = load(spark, sf, "customer")
    arr = F.array(F.struct(F.col("c_name").alias("name"), phone().alias("phone")),
                  F.struct(F.col("c_mktsegment").alias("name"),
                           phone(base=60).alias("phone")))
    return c.select("c_custkey", F.to_json(arr).alias("contacts"))


def contact_object_json(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    return c.select("c_custkey", phone().alias("phone"), F.to_json(F.struct(
        F.col("c_name").alias("name"), phone().alias("phone"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")))
        .alias("doc"))


KEY_WIDTH = 20  # digits of any non-negative bigint, so padded keys never truncate


def key_text(n: int) -> str:
    """Row-key text of a customer key (same padding as :func:`row_key`)."""
    return str(n).zfill(KEY_WIDTH)


def row_key(custkey: str) -> Column:
    return F.lpad(F.col(custkey).cast("string"), KEY_WIDTH, "0")


def customer_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Key-value cells: family ``info`` from customer (version 0) and family
    ``orders`` with one ``last_order``/``last_status`` version per order."""
    c = load(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("acctbal_cents"))
    info = unpivot_cells(c, row_key("c_custkey"), "info",
                         ["name", "nation", "segment", "acctbal_cents"])
    o = load(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("last_order"),
        F.col("o_orderstatus").alias("last_status"), "o_orderkey")
    orders = unpivot_cells(o, row_key("o_custkey"), "orders", ["last_order", "last_status"],
                           version=F.col("o_orderkey"))
    return info.unionByName(orders)


def geo_ranges(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "nation")
    r = load(spark, sf, "region")
    g = n.join(r, n.n_regionkey == r.r_regionkey)
    lo = F.col("n_nationkey").cast("bigint") * NATION_SPAN
    return g.select(lo.alias("lo"), (lo + RANGE_WIDTH).alias("hi"),
                    F.col("n_name").alias("country"), F.col("r_name").alias("region"))
