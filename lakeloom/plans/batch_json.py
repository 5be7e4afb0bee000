"""Registered JSON, reshaping and codec queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.json import parse, sorted_keys
from lakeloom.operators import reshape
from lakeloom.operators.kafka import parse_app_log
from lakeloom.operators.kv import rows_as_map
from lakeloom.plans import derived
from lakeloom.plans.registry import query
from lakeloom.schemas import CONTACT
from lakeloom.tables import load


@query("json_infer")
def q_json_infer(spark, sf):
    """Inferred over rows whose keys are missing, null, of one type or mixed:
    integers with fractions are doubles, numbers with texts are strings."""
    ev = load(spark, sf, "events")
    kind = F.pmod("event_id", F.lit(4))
    user = F.col("user_id").cast("string")
    doc = F.when(kind == 0, F.concat(F.lit('{"k":'), user, F.lit(',"mix":"a"'))) \
        .when(kind == 1, F.concat(F.lit('{"k":'), user, F.lit('.5,"mix":3'))) \
        .when(kind == 2, F.lit('{"mix":null,"only":true')).otherwise(F.lit('{"k":null'))
    doc = F.concat(doc, F.lit(',"props_k":'), F.get_json_object("props", "$.k"), F.lit("}"))
    return reshape.infer_and_parse(ev.select("event_id", doc.alias("doc")), ["event_id"], "doc")


@query("json_extract_typed")
def q_json_extract_typed(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", "event_type", parse("props", "k bigint").getField("k").alias("k"))


@query("json_tuple_fields")
def q_json_tuple_fields(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", F.json_tuple("props", "k").alias("k"))


@query("json_object_entries")
def q_json_object_entries(spark, sf):
    docs = derived.contact_object_json(spark, sf)
    return reshape.json_entries(docs, ["c_custkey"], "doc", drop=["phone"])


@query("json_sorted_keys")
def q_json_sorted_keys(spark, sf):
    docs = derived.contact_object_json(spark, sf)
    return docs.select("c_custkey", F.array_join(sorted_keys("doc"), ",").alias("keys"))


@query("explode_json_text")
def q_explode_json_text(spark, sf):
    return reshape.explode_json_text(derived.contacts_json(spark, sf), ["c_custkey"], "contacts",
                                     "contact")


@query("explode_json_array")
def q_explode_json_array(spark, sf):
    return reshape.explode_json_array(derived.contacts_json(spark, sf), ["c_custkey"], "contacts",
                                      CONTACT)


@query("contacts_table")
def q_contacts_table(spark, sf):
    elems = reshape.explode_json_text(derived.contacts_json(spark, sf), ["c_custkey"], "contacts",
                                      "contact")
    return reshape.elements_to_columns(elems, ["c_custkey"], "contact", CONTACT, "contacts")


@query("kafka_json_parse")
def q_kafka_json_parse(spark, sf):
    """Kafka record → key/topic/offset as strings, app-log JSON flattened."""
    return parse_app_log(derived.kafka_records(spark, sf))


@query("flatten_struct")
def q_flatten_struct(spark, sf):
    ev = load(spark, sf, "events")
    nested = ev.select("event_id", derived.app_log(ev).alias("log"))
    return nested.select("event_id", "log.create_time", "log.events.event_type",
                         "log.events.event_arg1")


@query("array_struct_project")
def q_array_struct_project(spark, sf):
    li = load(spark, sf, "lineitem")
    arr = F.array(
        F.struct(F.col("l_orderkey").alias("c0"), F.col("l_partkey").alias("c1"),
                 F.col("l_returnflag").alias("c2"), F.col("l_quantity").alias("c3"),
                 F.col("l_linenumber").alias("c4")),
        F.struct(F.col("l_suppkey").alias("c0"), F.col("l_partkey").alias("c1"),
                 F.col("l_linestatus").alias("c2"), F.col("l_tax").alias("c3"),
                 (F.col("l_linenumber") + 100).alias("c4")))
    kept = li.select("l_orderkey", "l_linenumber",
                     reshape.array_struct_project(arr, ["c2", "c4"]).alias("kept"))
    return kept.select("l_orderkey", "l_linenumber", F.posexplode("kept").alias("pos", "e")) \
        .select("l_orderkey", "l_linenumber", "pos", "e.c2", "e.c4")


@query("rows_to_json")
def q_rows_to_json(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return reshape.rows_to_json(c).select(F.col("json"))


@query("cell_codec")
def q_cell_codec(spark, sf):
    c = load(spark, sf, "customer")
    key_bytes = F.unhex(F.lpad(F.hex("c_custkey"), 16, "0"))  # 8 bytes, big-endian
    name_bytes = F.encode("c_name", "UTF-8")
    return c.select(
        "c_custkey", F.hex(key_bytes).alias("key_hex"),
        F.conv(F.hex(key_bytes), 16, 10).cast("bigint").alias("key_back"),
        F.hex(name_bytes).alias("name_hex"), F.decode(name_bytes, "UTF-8").alias("name_back"))


@query("rows_as_map")
def q_rows_as_map(spark, sf):
    c = load(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("NAME"), F.col("c_mktsegment").alias("SEGMENT"),
        derived.phone().alias("PHONE"), "c_acctbal")
    m = rows_as_map(c, ["c_custkey"], ["NAME", "SEGMENT", "PHONE"])
    sel = c.where(F.col("c_acctbal") > 0).select("c_custkey", m.alias("m"))
    return sel.select("c_custkey", F.try_element_at("m", F.lit("NAME")).alias("name"),
                      F.try_element_at("m", F.lit("MISSING")).alias("missing"))


@query("json_to_cells")
def q_json_to_cells(spark, sf):
    """JSON documents parsed into cells, one per entry, in cell order."""
    docs = derived.contact_object_json(spark, sf)
    cells = reshape.json_cells(docs, derived.row_key("c_custkey"), "doc", derived.CONTACT_FAMILY)
    return reshape.sorted_cells(cells).select("row_key", "family", "qualifier", "value")
