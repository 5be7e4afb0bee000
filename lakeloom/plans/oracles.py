"""DuckDB SQL equivalent of every registered query that SQL can express.

Tables are views over the same parquet files. Column names match the
Spark results exactly; sums of money go through DECIMAL so both engines
produce the same doubles.
"""

from __future__ import annotations

# A line split with Java String.split(" ") semantics, written for DuckDB.
_JAVA_SPLIT = (
    "CASE WHEN {l} = '' THEN [''] WHEN rtrim({l}, ' ') = '' THEN []::VARCHAR[] "
    "ELSE string_split(rtrim({l}, ' '), ' ') END"
)

# Lines of a text as a text file is read (LF, CR LF, CR; no line after a
# final terminator; empty text has no lines), written for DuckDB.
_LINES = (
    "CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array("
    "regexp_replace({t}, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') END"
)

ORACLES: dict[str, str] = {}

ORACLES["word_count"] = f"""
WITH lines AS (SELECT unnest({_LINES.format(t='text')}) AS l FROM documents),
words AS (SELECT unnest({_JAVA_SPLIT.format(l='l')}) AS word FROM lines)
SELECT word, count(*) AS cnt FROM words GROUP BY word
"""

ORACLES["conversation_word_count"] = f"""
WITH lines AS (SELECT unnest({_LINES.format(t='text')}) AS l FROM conversations),
words AS (SELECT unnest({_JAVA_SPLIT.format(l='l')}) AS word FROM lines)
SELECT word, count(*) AS cnt FROM words GROUP BY word
"""

ORACLES["split_tokens"] = """
SELECT conv_id, turn,
  len(string_split(text, ',')) AS n_comma, string_split(text, ',')[1] AS first_comma,
  len(string_split(text, ' ')) AS n_space, string_split(text, ' ')[1] AS first_space,
  len(string_split(text, '-')) AS n_dash, string_split(text, '-')[1] AS first_dash
FROM conversations
"""

ORACLES["explode_split"] = """
SELECT conv_id, turn, unnest(string_split(text, ' ')) AS token FROM conversations
"""

ORACLES["sum_by_key"] = """
SELECT l_suppkey,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
FROM lineitem GROUP BY l_suppkey ORDER BY l_suppkey
"""

ORACLES["count_by_group"] = "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type"

ORACLES["global_count"] = "SELECT count(*) AS n FROM events"

ORACLES["sql_over_view"] = """
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type
"""

ORACLES["set_by_key"] = """
SELECT user_id % 10 AS user_bucket,
  array_to_string(list_sort(list(DISTINCT hour(ts))), ',') AS hours
FROM events GROUP BY 1
"""

ORACLES["avg_all_numeric"] = """
SELECT l_returnflag, l_linestatus,
  round(avg(l_orderkey), 6) AS avg_l_orderkey, round(avg(l_partkey), 6) AS avg_l_partkey,
  round(avg(l_suppkey), 6) AS avg_l_suppkey, round(avg(l_linenumber), 6) AS avg_l_linenumber,
  round(avg(l_quantity), 6) AS avg_l_quantity, round(avg(l_extendedprice), 6) AS avg_l_extendedprice,
  round(avg(l_discount), 6) AS avg_l_discount, round(avg(l_tax), 6) AS avg_l_tax
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""

ORACLES["agg_by_spec"] = """
SELECT l_returnflag, max(l_quantity) AS max_l_quantity, min(l_discount) AS min_l_discount,
  count(l_tax) AS count_l_tax
FROM lineitem GROUP BY l_returnflag
"""

ORACLES["window_partition_total"] = """
SELECT event_type, event_id, user_id,
  CAST(sum(user_id) OVER (PARTITION BY event_type) AS BIGINT) AS type_user_sum,
  count(*) OVER (PARTITION BY event_type) AS type_rows
FROM events
"""

ORACLES["top_n_per_group"] = """
SELECT * FROM (
  SELECT event_type, user_id, cnt,
    row_number() OVER (PARTITION BY event_type ORDER BY cnt DESC, user_id) AS rn
  FROM (SELECT event_type, user_id, count(*) AS cnt FROM events GROUP BY 1, 2)
) WHERE rn <= 2
"""

ORACLES["sort_desc_limit"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
"""

ORACLES["union_many"] = """
SELECT o_orderkey AS key, o_orderstatus AS label, o_totalprice AS amount FROM orders
UNION ALL SELECT l_orderkey, l_returnflag, l_extendedprice FROM lineitem
UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
UNION ALL SELECT p_partkey, p_brand, p_retailprice FROM part
"""

ORACLES["cast_all_to_string"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
"""

ORACLES["describe_schema"] = """
SELECT 'event_id' AS col_name, 'bigint' AS data_type, count(event_id) AS non_null FROM events
UNION ALL SELECT 'ts', 'timestamp_ntz', count(ts) FROM events
UNION ALL SELECT 'user_id', 'bigint', count(user_id) FROM events
UNION ALL SELECT 'event_type', 'string', count(event_type) FROM events
UNION ALL SELECT 'value', 'double', count(value) FROM events
UNION ALL SELECT 'props', 'string', count(props) FROM events
"""

ORACLES["project_columns"] = "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders"

ORACLES["rename_columns"] = """
SELECT c_custkey AS custkey, c_name AS name, c_mktsegment AS segment FROM customer
"""

ORACLES["arith_project"] = """
SELECT l_orderkey, l_linenumber + 1 AS linenumber_plus_one,
  l_orderkey * 10 + l_linenumber AS line_id, CAST(l_quantity AS BIGINT) // 10 AS qty_div_10
FROM lineitem
"""

ORACLES["filter_even"] = "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber % 2 = 0"

ORACLES["filter_expr"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity > 25 AND l_discount <= 0.05
"""

ORACLES["filter_compare"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 5000"

ORACLES["drop_null_rows"] = """
SELECT c_custkey, c_mktsegment, n_orders FROM customer
JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o
  ON c_custkey = o_custkey
WHERE c_mktsegment <> 'BUILDING'
"""

ORACLES["device_signal_filter"] = "SELECT user_id AS device, event_id FROM events WHERE value > 10"

ORACLES["device_avg"] = """
SELECT event_type AS device_type, round(avg(value), 6) AS avg_signal FROM events GROUP BY 1
"""

ORACLES["scan_parquet"] = """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
"""

ORACLES["literal_rows"] = """
WITH w(event_type, weight) AS (VALUES ('view', 1), ('click', 2), ('purchase', 3),
  ('signup', 4), ('error', 5))
SELECT e.event_type, w.weight, count(*) AS n, count(*) * w.weight AS weighted
FROM events e JOIN w ON e.event_type = w.event_type GROUP BY e.event_type, w.weight
"""

ORACLES["bitmap_distinct"] = """
SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type
"""

ORACLES["dedup_keep_first"] = """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1
"""

_PHONE = "'1' || CAST(c_nationkey + 30 AS VARCHAR) || lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0')"

# Fixed value: the mobile-number pattern (see functions/text.py).
ORACLES["valid_mobile"] = f"""
SELECT c_custkey, {_PHONE} AS phone,
  regexp_full_match({_PHONE}, '(13[0-9]|14[579]|15[0-35-9]|16[6]|17[0135678]|18[0-9]|19[89])[0-9]{{8}}') AS is_valid
FROM customer
"""

ORACLES["phone_prefix"] = f"SELECT c_custkey, substr({_PHONE}, 1, 7) AS prefix FROM customer"

ORACLES["exact_decimal_sum"] = """
SELECT l_returnflag,
  CAST(sum(CAST(l_discount AS DECIMAL(5,2))) AS VARCHAR) AS sum_discount,
  CAST(CAST(1 AS DECIMAL(5,2)) * count(*) - sum(CAST(l_discount AS DECIMAL(5,2))) AS VARCHAR) AS rest
FROM lineitem GROUP BY l_returnflag
"""

ORACLES["max_by_groups"] = """
SELECT n_name, max_by(c_custkey, (c_acctbal, c_custkey)) AS top_custkey
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
"""

# ---- JSON and reshaping -------------------------------------------------

_PHONE60 = "'1' || CAST(c_nationkey + 60 AS VARCHAR) || lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0')"
_CONTACTS = (
    f"""'[{{"name":"' || c_name || '","phone":"' || {_PHONE} || '"}},{{"name":"' """
    f"""|| c_mktsegment || '","phone":"' || {_PHONE60} || '"}}]'"""
)
_TS6 = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_CENTS = "CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)"
_IPNUM = "(((user_id % 2147483648) * 2654435761) % 4294967296)"
_IP = (f"concat_ws('.', ({_IPNUM} >> 24) % 256, ({_IPNUM} >> 16) % 256, "
       f"({_IPNUM} >> 8) % 256, {_IPNUM} % 256)")
_EVENTS_JSON = (
    f"""'{{"event_type":"' || event_type || '","event_id":"' || event_id || '","event_ts":"' """
    f"""|| {_TS6} || '","event_arg1":"' || {_CENTS} || '"}}'"""
)
_APP_LOG_JSON = (
    f"""'{{"create_time":"' || {_TS6} || '","user_uuid":"' || user_id || '","ip":"' || {_IP} """
    f"""|| '","events":' || {_EVENTS_JSON} || '}}'"""
)

ORACLES["json_infer"] = """
SELECT event_id,
  CASE event_id % 4 WHEN 0 THEN CAST(user_id AS DOUBLE) WHEN 1 THEN user_id + 0.5 END AS k,
  CASE event_id % 4 WHEN 0 THEN 'a' WHEN 1 THEN '3' END AS mix,
  CASE WHEN event_id % 4 = 2 THEN true END AS "only",
  CAST(props->>'k' AS BIGINT) AS props_k
FROM events
"""

ORACLES["json_extract_typed"] = """
SELECT event_id, event_type, CAST(props->>'k' AS BIGINT) AS k FROM events
"""

ORACLES["json_tuple_fields"] = "SELECT event_id, props->>'k' AS k FROM events"

ORACLES["json_object_entries"] = f"""
SELECT c_custkey, key, value FROM (
  SELECT c_custkey, c_name AS name, c_mktsegment AS segment,
    CAST(c_nationkey AS VARCHAR) AS nation FROM customer)
UNPIVOT (value FOR key IN (name, segment, nation))
"""

ORACLES["json_sorted_keys"] = "SELECT c_custkey, 'name,nation,phone,segment' AS keys FROM customer"

ORACLES["explode_json_text"] = f"""
SELECT c_custkey, unnest(CAST(json_extract({_CONTACTS}, '$[*]') AS VARCHAR[])) AS contact
FROM customer
"""

ORACLES["explode_json_array"] = f"""
SELECT c_custkey, c_name AS name, {_PHONE} AS phone FROM customer
UNION ALL SELECT c_custkey, c_mktsegment, {_PHONE60} FROM customer
"""

ORACLES["contacts_table"] = f"""
SELECT c_custkey, c_name AS contacts_name, {_PHONE} AS contacts_phone FROM customer
UNION ALL SELECT c_custkey, c_mktsegment, {_PHONE60} FROM customer
"""

_NULLS = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in
                   ["imei", "mac", "os_version", "bu", "app_version", "net", "gps"])

ORACLES["kafka_json_parse"] = f"""
SELECT CAST(user_id AS VARCHAR) AS key, 'app_logs' AS topic, CAST(event_id AS VARCHAR) AS "offset",
  {_TS6} AS create_time, CAST(user_id AS VARCHAR) AS user_uuid, {_IP} AS ip,
  {_NULLS}, {_EVENTS_JSON} AS events
FROM events
"""

ORACLES["flatten_struct"] = f"""
SELECT event_id, {_TS6} AS create_time, event_type, {_CENTS} AS event_arg1 FROM events
"""

ORACLES["array_struct_project"] = """
SELECT l_orderkey, l_linenumber, 0 AS pos, l_returnflag AS c2, l_linenumber AS c4 FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 1, l_linestatus, l_linenumber + 100 FROM lineitem
"""

ORACLES["rows_to_json"] = """
SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":'
  || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS json FROM customer
"""

ORACLES["cell_codec"] = """
SELECT c_custkey, lpad(hex(c_custkey), 16, '0') AS key_hex, c_custkey AS key_back,
  hex(c_name) AS name_hex, c_name AS name_back FROM customer
"""

ORACLES["rows_as_map"] = f"""
SELECT c_custkey, c_name AS name, CAST(NULL AS VARCHAR) AS missing FROM customer
WHERE c_acctbal > 0
"""

ORACLES["json_to_cells"] = f"""
SELECT row_key, 'cf' AS family, qualifier, value FROM (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 20, '0') AS row_key, c_name AS name, {_PHONE} AS phone,
    c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer)
UNPIVOT (value FOR qualifier IN (name, phone, segment, nation))
"""

# ---- key-value cells ------------------------------------------------------

_CELLS = """
WITH info AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 20, '0') AS row_key, 'info' AS family, qualifier,
    CAST(0 AS BIGINT) AS version, value
  FROM (SELECT c_custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
          c_mktsegment AS segment,
          CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS acctbal_cents
        FROM customer)
  UNPIVOT (value FOR qualifier IN (name, nation, segment, acctbal_cents))),
ord AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 20, '0') AS row_key, 'orders' AS family, qualifier,
    o_orderkey AS version, value
  FROM (SELECT o_custkey, o_orderkey, CAST(o_orderkey AS VARCHAR) AS last_order,
          o_orderstatus AS last_status FROM orders)
  UNPIVOT (value FOR qualifier IN (last_order, last_status))),
cells AS (SELECT * FROM info UNION ALL SELECT * FROM ord),
latest AS (SELECT row_key, family, qualifier, arg_max(value, version) AS value,
             max(version) AS version FROM cells GROUP BY row_key, family, qualifier)
"""

_ROWS = """
SELECT lpad(CAST(coalesce(c_custkey, o.o_custkey) AS VARCHAR), 20, '0') AS row_key, c_name AS name,
  c_nationkey AS nation, c_mktsegment AS segment,
  CAST(round(c_acctbal * 100) AS BIGINT) AS acctbal_cents, o.last_order, o.last_status
FROM customer FULL JOIN (
  SELECT o_custkey, max(o_orderkey) AS last_order, arg_max(o_orderstatus, o_orderkey) AS last_status
  FROM orders GROUP BY o_custkey) o ON c_custkey = o.o_custkey
"""

ORACLES["cells_to_rows"] = _ROWS

ORACLES["kv_range_scan"] = f"""
SELECT row_key, name, nation FROM ({_ROWS})
WHERE row_key >= '00000000000000000100' AND row_key < '00000000000000000600'
"""

ORACLES["kv_get"] = _CELLS + "SELECT * FROM latest WHERE row_key = '00000000000000000042'"

ORACLES["kv_scan_family"] = _CELLS + "SELECT * FROM latest WHERE family = 'orders'"

ORACLES["latest_cell"] = _CELLS + "SELECT * FROM latest"

ORACLES["kv_scan_concat"] = _CELLS + """
SELECT row_key, string_agg(value, '  ' ORDER BY family, qualifier) AS "values"
FROM latest GROUP BY row_key
"""

ORACLES["kv_put"] = """
SELECT lpad(CAST(coalesce(c_custkey, f.o_custkey) AS VARCHAR), 20, '0') AS row_key,
  CASE WHEN f.o_custkey IS NOT NULL THEN 'HAS_F_ORDER' ELSE c_mktsegment END AS segment
FROM customer FULL OUTER JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') f
  ON c_custkey = f.o_custkey
"""

ORACLES["kv_upsert"] = """
SELECT c_custkey, c_name,
  CASE WHEN c_acctbal < 0 THEN 'OVERDRAWN' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal
FROM customer
UNION ALL SELECT -s_suppkey - 1, s_name, 'SUPPLIER', s_acctbal FROM supplier
"""

# ---- offset ledger ------------------------------------------------------

_REC = f"""
WITH rec AS (
  SELECT 'app_logs' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
    ts, {_APP_LOG_JSON} AS value FROM events),
every AS (
  SELECT topic, 'lakeloom-consumer' AS group_id, epoch_ms(date_trunc('day', ts)) AS batch_ms,
    partition, max("offset") + 1 AS until_offset
  FROM rec GROUP BY ALL),
hist AS (
  SELECT topic, 'lakeloom-consumer' AS group_id, epoch_ms(date_trunc('day', ts)) AS batch_ms,
    partition, max("offset") + 1 AS until_offset
  FROM rec WHERE ts < TIMESTAMP '2024-01-20' AND partition <> 3 GROUP BY ALL),
resolved AS (
  SELECT coalesce(n.topic, c.topic) AS topic, coalesce(n.partition, c.partition) AS partition,
    coalesce(n.until_offset, 0) AS from_offset
  FROM (SELECT topic, partition, arg_max(until_offset, batch_ms) AS until_offset
        FROM hist GROUP BY topic, partition) n
  FULL OUTER JOIN (SELECT DISTINCT topic, partition FROM rec) c
    ON n.topic = c.topic AND n.partition = c.partition)
"""

ORACLES["topic_partitions"] = _REC + """
SELECT topic, partition, count(*) AS records FROM rec GROUP BY topic, partition
"""

ORACLES["last_per_partition"] = _REC + """
SELECT topic, partition, max("offset") AS last_offset, arg_max(value, "offset") AS last_value
FROM rec GROUP BY topic, partition
"""

ORACLES["offset_snapshot"] = _REC + """
SELECT topic, partition, max("offset") + 1 AS until_offset, arg_max(value, "offset") AS data
FROM rec GROUP BY topic, partition
"""

ORACLES["offset_history"] = _REC + """
SELECT topic, 'lakeloom-consumer' AS group_id, epoch_ms(date_trunc('day', ts)) AS batch_ms,
  partition, max("offset") + 1 AS until_offset FROM rec GROUP BY ALL
"""

ORACLES["offsets_encode"] = _REC + """
SELECT topic, group_id, batch_ms,
  string_agg(topic || ':' || partition || ':' || until_offset, ',' ORDER BY partition) AS offsets
FROM every GROUP BY topic, group_id, batch_ms
"""

ORACLES["offsets_decode"] = _REC + """
SELECT group_id, batch_ms, topic, partition, until_offset FROM every
"""

ORACLES["offsets_from_batch"] = _REC + """
SELECT topic, batch_ms,
  string_agg(topic || ':' || partition || ':' || from_offset, ',' ORDER BY partition) AS offsets
FROM (SELECT topic, epoch_ms(date_trunc('day', ts)) AS batch_ms, partition,
        min("offset") AS from_offset FROM rec GROUP BY ALL)
GROUP BY topic, batch_ms
"""

ORACLES["resolve_offsets"] = _REC + "SELECT topic, partition, from_offset FROM resolved"

ORACLES["starting_offsets_json"] = _REC + """
SELECT '{' || string_agg(j, ',' ORDER BY topic) || '}' AS starting_offsets FROM (
  SELECT topic, '"' || topic || '":{' ||
    string_agg('"' || partition || '":' || from_offset, ',' ORDER BY partition) || '}' AS j
  FROM resolved GROUP BY topic)
"""

ORACLES["offset_payload_join"] = _REC + """
SELECT p.topic, p.partition, coalesce(p.from_offset, 0) AS from_offset, p.until_offset,
  coalesce(d.data, '') AS data
FROM (SELECT topic, partition, max("offset") + 1 AS until_offset,
        max(CASE WHEN ts < TIMESTAMP '2024-01-30 23:50:00' THEN "offset" + 1 END) AS from_offset
      FROM rec GROUP BY topic, partition) p
LEFT JOIN (SELECT topic, partition, arg_max(value, "offset") AS data FROM rec
           WHERE ts >= TIMESTAMP '2024-01-30 23:50:00' GROUP BY topic, partition) d
  ON p.topic = d.topic AND p.partition = d.partition
"""

# ---- calendar, windows, interval and range joins -------------------------

ORACLES["previous_month"] = """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m') AS prev_month
FROM orders
"""

_SPINE = """
SELECT strftime(date_trunc('month', (SELECT max(o_orderdate) FROM orders)) - k * INTERVAL 1 MONTH,
  '%Y-%m') AS month FROM range(0, 49) t(k)
"""

ORACLES["month_spine"] = _SPINE

ORACLES["monthly_counts_filled"] = f"""
SELECT s.month, coalesce(c.cnt, 0) AS cnt FROM ({_SPINE}) s
LEFT JOIN (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS cnt FROM orders GROUP BY 1) c
  ON s.month = c.month
"""

ORACLES["sliding_count"] = """
SELECT s AS window_start, s + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS cnt
FROM (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE AS s
      FROM events, range(0, 2) t(k))
GROUP BY ALL
"""

ORACLES["tumbling_count"] = """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  event_type, count(*) AS cnt FROM events GROUP BY ALL
"""

ORACLES["interval_join"] = """
SELECT v.event_id AS view_id, c.event_id AS click_id, v.user_id
FROM events v JOIN events c ON v.user_id = c.user_id AND c.event_type = 'click'
  AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR
WHERE v.event_type = 'view'
"""

ORACLES["interval_left_join"] = """
SELECT v.event_id AS view_id, c.event_id AS click_id, v.user_id
FROM events v LEFT JOIN events c ON v.user_id = c.user_id AND c.event_type = 'click'
  AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR
WHERE v.event_type = 'view'
"""

ORACLES["ip_range_join"] = f"""
WITH g AS (
  SELECT CAST(n_nationkey AS BIGINT) * 171798692 AS lo,
    CAST(n_nationkey AS BIGINT) * 171798692 + 150000000 AS hi, n_name AS country, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT event_id, {_IP} AS ip, g.country, g.region
FROM events LEFT JOIN g ON {_IPNUM} BETWEEN g.lo AND g.hi
"""

# ---- streaming jobs (final sink contents) ---------------------------------

ORACLES["stream_word_count"] = ORACLES["word_count"]

ORACLES["stream_sliding_count"] = ORACLES["sliding_count"]
ORACLES["stream_sliding_complete"] = ORACLES["sliding_count"]

ORACLES["stream_tumbling_count"] = ORACLES["tumbling_count"]

ORACLES["stream_dedup"] = "SELECT DISTINCT user_id, event_type FROM events"

ORACLES["stream_dedup_watermark"] = "SELECT DISTINCT user_id, ts FROM events"

ORACLES["stream_interval_join"] = ORACLES["interval_join"]

ORACLES["stream_interval_left_join"] = ORACLES["interval_left_join"]

ORACLES["stream_kafka_to_parquet"] = ORACLES["kafka_json_parse"]

ORACLES["stream_filter"] = """
SELECT CAST(user_id AS VARCHAR) AS device, value AS signal FROM events WHERE value > 10
"""

ORACLES["stream_group_count"] = """
SELECT event_type AS deviceType, count(*) AS cnt FROM events GROUP BY event_type
"""

ORACLES["stream_device_avg"] = """
SELECT event_type AS deviceType, round(avg(value), 6) AS avg_signal FROM events GROUP BY event_type
"""

ORACLES["stream_global_count"] = "SELECT count(*) AS n FROM events"

# Records arrive in three drops of equal time; those without a time come first.
ORACLES["stream_at_least_once"] = _REC + """,
span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) - epoch_us(min(ts)) AS width FROM rec)
SELECT topic, partition, min("offset") AS from_offset,
  CASE WHEN ts IS NULL OR epoch_us(ts) < lo + CAST(round(width / 3.0) AS BIGINT) THEN 0
       WHEN epoch_us(ts) < lo + CAST(round(width * 2 / 3.0) AS BIGINT) THEN 1 ELSE 2 END AS batch_id
FROM rec, span GROUP BY ALL
"""
ORACLES["union_append_partitioned"] = """
SELECT event_id, event_type AS label, 'event' AS kind FROM events
UNION ALL SELECT o_orderkey, o_orderstatus, 'order' FROM orders
UNION ALL SELECT c_custkey, c_mktsegment, 'customer' FROM customer
"""

ORACLES["stream_offset_ledger"] = _REC + """
SELECT topic, partition, max("offset") + 1 AS until_offset, arg_max(value, "offset") AS data
FROM rec GROUP BY topic, partition
"""

# ---- connector round trips -----------------------------------------------

ORACLES["scan_text"] = ORACLES["word_count"]
ORACLES["scan_csv"] = "SELECT * FROM events"
ORACLES["roundtrip_json"] = "SELECT * FROM events"
ORACLES["roundtrip_orc"] = "SELECT * FROM orders"
ORACLES["table_append_partitioned"] = """
SELECT event_id, user_id, value, event_type FROM events
UNION ALL
SELECT event_id, user_id, value, event_type FROM events
"""
ORACLES["empty_with_schema"] = "SELECT * FROM orders"
ORACLES["stream_csv"] = "SELECT * FROM events"
ORACLES["stream_line_word_count"] = ORACLES["word_count"]
ORACLES["scan_table"] = """
SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS max_key FROM orders GROUP BY o_orderstatus
"""
ORACLES["table_scan_pruned"] = """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'
"""
ORACLES["stream_parquet"] = "SELECT * FROM orders"
ORACLES["stream_watermark_count"] = f"""
SELECT * FROM ({ORACLES["tumbling_count"]})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
"""
ORACLES["stream_late_drop"] = ORACLES["stream_sliding_count"]
ORACLES["ip_visitors_bitmap"] = f"""
SELECT CAST(ts AS DATE) AS day, count(DISTINCT {_IP}) AS visitors FROM events GROUP BY 1
"""
ORACLES["observed_metrics"] = """
SELECT count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents FROM events
"""
ORACLES["catalog_ops"] = """
SELECT c_mktsegment, count(*) AS n, true AS listed FROM customer GROUP BY c_mktsegment
"""
ORACLES["cells_to_rows_bucketed"] = ORACLES["cells_to_rows"]
ORACLES["kv_get_bucketed"] = ORACLES["kv_get"]
ORACLES["stream_ledger_resume"] = _REC + """
SELECT '{"app_logs":{' || string_agg('"' || partition || '":' || u, ',' ORDER BY partition) || '}}'
  AS starting_offsets
FROM (SELECT partition, max("offset") + 1 AS u FROM rec GROUP BY partition)
"""

# ---- streams that are interrupted, lag behind or keep their own state -----

ORACLES["stream_two_watermarks"] = ORACLES["interval_left_join"]

ORACLES["stream_resume"] = ORACLES["stream_sliding_count"]

ORACLES["stream_resume_sink"] = "SELECT event_id, user_id, event_type FROM events"

ORACLES["stream_commit_ledger"] = ORACLES["stream_offset_ledger"]

ORACLES["stream_processing_time"] = ORACLES["stream_group_count"]

ORACLES["stream_offset_gaps"] = _REC + """,
steps AS (
  SELECT topic, partition, "offset", value, lag("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") AS before
  FROM rec)
SELECT 'gap' AS kind, topic, partition, before AS from_offset, "offset" AS to_offset, "offset" - before - 1 AS n_missing,
  NULL AS data
FROM steps WHERE "offset" - before > 1
UNION ALL
SELECT 'idle', topic, partition, max("offset"), max("offset"),
  CAST(coalesce(sum("offset" - before - 1), 0) AS BIGINT), arg_max(value, "offset")
FROM steps GROUP BY topic, partition
"""

# ---- reading and writing by parts ------------------------------------------

ORACLES["stride_scan"] = """
SELECT o_orderkey, o_custkey, o_totalprice,
  CAST(CASE WHEN o_orderkey IS NULL THEN 0 ELSE len(list_filter(
    list_transform(range(1, 10), lambda k: 1 + (5999 * k) // 10), lambda cut: cut <= o_orderkey)) END AS INTEGER) AS split
FROM orders
"""

ORACLES["predicate_scan"] = """
SELECT event_id, ts, event_type,
  CASE WHEN ts IS NULL OR ts < TIMESTAMP '2024-01-10' THEN 0 WHEN ts < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS split
FROM events
"""

ORACLES["bulk_cells"] = _CELLS + "SELECT row_key, family, qualifier, version, value FROM cells"

ORACLES["cell_source_range"] = _CELLS + """
SELECT row_key, family, qualifier, version, value FROM cells
WHERE row_key >= '00000000000000000100' AND row_key < '00000000000000000600'
"""

ORACLES["ip_lookup_shipped"] = f"""
WITH g AS (
  SELECT CAST(n_nationkey AS BIGINT) * 171798692 AS lo,
    CAST(n_nationkey AS BIGINT) * 171798692 + 150000000 AS hi, n_name AS country, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT CAST(r_regionkey AS BIGINT) * 858993459, CAST(r_regionkey AS BIGINT) * 858993459 + 858993458, '?', r_name FROM region)
SELECT event_id, {_IP} AS ip, g.country, g.region
FROM events LEFT JOIN g ON {_IPNUM} BETWEEN g.lo AND g.hi
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY hi - lo, lo, country, region) = 1
"""

ORACLES["bitmap_rollup"] = """
SELECT 'day' AS span, CAST(ts AS DATE) AS start, count(DISTINCT user_id) AS visitors FROM events GROUP BY ALL
UNION ALL SELECT 'week', CAST(date_trunc('week', ts) AS DATE), count(DISTINCT user_id) FROM events GROUP BY ALL
UNION ALL SELECT 'all', CAST(NULL AS DATE), count(DISTINCT user_id) FROM events
"""

ORACLES["explode_json_marks"] = f"""
WITH c AS (SELECT c_custkey, c_name AS name, {_PHONE} AS phone FROM customer
UNION ALL SELECT c_custkey, c_mktsegment, {_PHONE60} FROM customer)
SELECT *, string_split(name, '#')[1] AS kind, string_split(name, '#')[-1] AS number FROM c
"""
