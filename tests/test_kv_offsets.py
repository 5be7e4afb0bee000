"""Key-value cells and the offset ledger: range scans, newest versions, upserts, the three resolution cases."""

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.operators import kv
from lakeloom.operators import offsets as off
from lakeloom.schemas import CELL_SCHEMA, LEDGER_SCHEMA

CELLS = [("r1", "info", "name", 1, "old"), ("r1", "info", "name", 2, "new"),
         ("r1", "info", "age", 1, "30"), ("r2", "info", "name", 1, "bob"),
         ("r2", "info", "age", 1, "x"), ("r3", "cf_offset", "offset", 1, "7"),
         ("r4", "info", "name", 5, "eve")]


def cells(spark):
    return spark.createDataFrame(CELLS, CELL_SCHEMA)


def test_range_scan_is_half_open(spark):
    got = sorted({r.row_key for r in kv.range_scan(cells(spark), "r1", "r3").collect()})
    assert got == ["r1", "r2"]
    assert kv.get(cells(spark), "r4").count() == 1
    assert kv.scan_family(cells(spark), "cf_offset").count() == 1


def test_rows_take_newest_version_and_try_cast(spark):
    rows = kv.cells_to_rows(cells(spark), "info", ["name", "age"], {"age": "int"})
    got = {r.row_key: (r.name, r.age) for r in rows.collect()}
    assert got == {"r1": ("new", 30), "r2": ("bob", None), "r4": ("eve", None)}


def test_concat_values(spark):
    got = {r.row_key: r["values"] for r in kv.concat_values(cells(spark)).collect()}
    assert got["r1"] == "30  new"


def test_upsert_inserts_and_replaces(spark):
    target = spark.createDataFrame([(1, "1", 1), (2, "2", 2), (3, "3", 3)],
                                   "id bigint, col1 string, col2 int")
    changes = spark.createDataFrame([(2, "two", 20, 1), (2, "TWO", 21, 2), (4, "4", 4, 1)],
                                    "id bigint, col1 string, col2 int, v int")
    out = kv.upsert(target, changes, ["id"], order=["v"])
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "1", 1), (2, "TWO", 21), (3, "3", 3), (4, "4", 4)]


def ledger(spark, rows):
    return spark.createDataFrame([("t", "g", ms, p, o) for ms, p, o in rows], LEDGER_SCHEMA)


def current(spark, parts):
    return spark.createDataFrame([("t", p) for p in parts], "topic string, partition int")


def resolved(spark, hist, parts):
    return {r.partition: r.from_offset for r in
            off.resolve_offsets(ledger(spark, hist), current(spark, parts), "g").collect()}


def test_resolve_offsets_cases(spark):
    hist = [(1, 0, 3), (1, 1, 4), (2, 0, 9), (2, 1, 8)]
    assert resolved(spark, [], [0, 1, 2]) == {0: 0, 1: 0, 2: 0}          # first start
    assert resolved(spark, hist, [0, 1, 2]) == {0: 9, 1: 8, 2: 0}        # partitions grew
    assert resolved(spark, hist, [0, 1]) == {0: 9, 1: 8}                 # restart
    assert resolved(spark, hist, [0]) == {0: 9, 1: 8}                    # topic shrank
    # another group's commits are ignored
    other = spark.createDataFrame([("t", "h", 5, 0, 99)], LEDGER_SCHEMA)
    res = off.resolve_offsets(ledger(spark, hist).unionByName(other), current(spark, [0]), "g")
    assert {r.partition: r.from_offset for r in res.collect()} == {0: 9, 1: 8}


def test_starting_offsets_json(spark):
    res = spark.createDataFrame([("b", 0, 5), ("a", 10, 1), ("a", 2, 7)],
                                "topic string, partition int, from_offset bigint")
    js = off.starting_offsets_json(res).first().starting_offsets
    assert js == '{"a":{"2":7,"10":1},"b":{"0":5}}'


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(0, 10**12), min_size=1, max_size=8))
def test_offsets_encode_decode_round_trip(spark, parts):
    df = spark.createDataFrame([("top-ic", p, o) for p, o in parts.items()],
                               "topic string, partition int, offset bigint")
    enc = off.encode_offsets(df, [], "offset")
    s = enc.first().offsets
    assert s == ",".join(f"top-ic:{p}:{o}" for p, o in sorted(parts.items()))
    back = off.decode_offsets(enc, [], "offsets")
    assert {(r.partition, r.offset) for r in back.collect()} == set(parts.items())


def test_decode_rejects_malformed(spark):
    df = spark.createDataFrame([("123",), ("t:0:5,t:x:1,t:1:2:3,:2:2,t:3:9",)], "s string")
    got = sorted((r.topic, r.partition, r.offset) for r in off.decode_offsets(df, [], "s").collect())
    assert got == [("t", 0, 5), ("t", 3, 9)]


def test_snapshot_and_payload(spark):
    rec = spark.createDataFrame([("t", 0, 5, "a"), ("t", 0, 7, "b"), ("t", 1, 2, "c")],
                                "topic string, partition int, offset bigint, value string")
    snap = {r.partition: (r.until_offset, r.data) for r in off.offset_snapshot(rec).collect()}
    assert snap == {0: (8, "b"), 1: (3, "c")}
    ranges = spark.createDataFrame([("t", 0), ("t", 1), ("t", 2)], "topic string, partition int")
    pay = off.offset_snapshot(rec).select("topic", "partition", "data")
    got = {r.partition: r.data for r in off.attach_payload(ranges, pay).collect()}
    assert got == {0: "b", 1: "c", 2: ""}


def test_newest_commit_wins_after_a_rewind(spark):
    from lakeloom.streaming.sinks import committed_offsets
    rows = [("t", 0, 100, "late", 0), ("t", 0, 5, "rewound", 1), ("t", 1, 7, "x", 0)]
    log = spark.createDataFrame(rows, "topic string, partition int, until_offset bigint, data string, batch_id int")
    got = sorted((r.partition, r.until_offset, r.data) for r in committed_offsets(log).collect())
    assert got == [(0, 5, "rewound"), (1, 7, "x")]


def test_upsert_replaces_null_keys(spark):
    target = spark.createDataFrame([(None, "old"), (1, "a")], "k int, v string")
    changes = spark.createDataFrame([(None, "new")], "k int, v string")
    assert sorted((str(r.k), r.v) for r in kv.upsert(target, changes, ["k"], ["v"]).collect()) == [
        ("1", "a"), ("None", "new")]


def test_kafka_start_options_without_any_partition(spark):
    none = spark.createDataFrame([], "topic string, partition int")
    assert off.kafka_start_options(ledger(spark, []), none, "t", "g") == {
        "subscribe": "t", "startingOffsets": "latest"}


def test_kafka_start_options(spark):
    import json
    cur = spark.createDataFrame([("t", 0), ("t", 1), ("t", 2)], "topic string, partition int")
    assert off.kafka_start_options(None, cur, "t", "g") == {
        "subscribe": "t", "startingOffsets": "latest"}
    opts = off.kafka_start_options(ledger(spark, [(2, 0, 9), (2, 1, 8)]), cur, "t", "g")
    assert json.loads(opts["assign"]) == {"t": [0, 1, 2]}
    assert opts["startingOffsets"] == '{"t":{"0":9,"1":8,"2":0}}'


def test_union_many_checkpointed(spark):
    from lakeloom.operators.relational import union_many_checkpointed
    parts = [spark.range(i * 10, i * 10 + 10) for i in range(7)]
    out = union_many_checkpointed(parts, every=3)
    assert sorted(r.id for r in out.collect()) == list(range(70))


def test_checkpoint_root_uses_configured_dir(spark, tmp):
    from lakeloom.session import checkpoint_root
    assert checkpoint_root(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")


def test_upsert_duplicate_changes_without_order_keep_one(spark):
    target = spark.createDataFrame([(7, "old")], "k int, v string")
    changes = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c")], "k int, v string")
    out = kv.upsert(target, changes, ["k"]).collect()
    assert sorted(r.k for r in out) == [7, 8]
    assert {r.v for r in out if r.k == 7} <= {"a", "b"}


def test_checkpoint_root_refuses_local_fallback_on_clusters():
    import pytest
    from lakeloom.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError):
        checkpoint_root(Session())


def test_key_ordered_table_round_trip(spark, tmp):
    rows = [(f"{i:04d}", "f", "q", v, f"{i}-{v}") for i in range(200) for v in (0, 1)]
    cells = spark.createDataFrame(rows, "row_key string, family string, qualifier string, version bigint, value string")
    kv.write_table(cells, f"{tmp}/cells", num_partitions=4)
    stored = kv.read_table(spark, f"{tmp}/cells")
    assert [r.value for r in kv.latest_cells(kv.get(stored, "0042")).collect()] == ["42-1"]
    got = kv.range_scan(stored, "0010", "0012").collect()
    assert sorted((r.row_key, r.version) for r in got) == [("0010", 0), ("0010", 1), ("0011", 0), ("0011", 1)]
