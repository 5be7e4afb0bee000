"""Aggregations, top-N, group totals, bitmaps, dedup: goldens on the inline fixtures and properties."""

from pyspark.sql import functions as F

from lakeloom.operators import aggregate as agg
from lakeloom.operators import windows

# A missing key, an explicit null and values.
PEOPLE = [
    "{'name':'ada','age':null}", "{'name':'ada'}", "{'name':'ada','age':31}", "{'name':'ada','age':31}",
    "{'name':'bo','age':7}", "{'name':'cleo','age':64}", "{'name':'cleo','age':64}", "{'name':'cleo','age':12}",
    "{'name':'cleo','age':45}",
]


def people(spark):
    rdd_free = spark.createDataFrame([(p,) for p in PEOPLE], "value string")
    # single-quoted JSON is accepted
    return rdd_free.select(F.from_json("value", "name string, age bigint",
                                       {"allowSingleQuotes": "true"}).alias("p")).select("p.*")


def test_count_ignores_nulls_and_top_n(spark):
    df = people(spark)
    counts = agg.agg_by_spec(df, ["name", "age"], {"age": "count"})
    got = {(r.name, r.age): r.count_age for r in counts.collect()}
    assert got[("ada", None)] == 0
    assert got[("ada", 31)] == 2
    top = windows.top_n_per_group(counts, ["name"], [F.desc("count_age"), F.asc("age")], 2)
    rows = [(r.name, r.age, r.rn) for r in top.collect()]
    assert ("cleo", 64, 1) in rows and ("cleo", 12, 2) in rows
    assert all(r[2] <= 2 for r in rows) and len(rows) == 5


def test_set_by_key_golden(spark):
    df = spark.range(1, 16).select(F.col("id").cast("int").alias("x"))
    s = agg.set_by_key(df, F.expr("x % 10"), F.expr("x div 10"))
    got = {r.key: r.vals for r in s.collect()}
    assert got == {0: [1], 1: [0, 1], 2: [0, 1], 3: [0, 1], 4: [0, 1], 5: [0, 1],
                   6: [0], 7: [0], 8: [0], 9: [0]}


def test_set_by_key_in_long_form(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3)], "k string, v int")
    got = sorted(tuple(map(str, r)) for r in agg.set_by_key_rows(df, F.col("k"), F.col("v")).collect())
    assert got == [("None", "3"), ("a", "1"), ("a", "2")]


def test_top_n_beyond_the_rank_limit(spark):
    df = spark.range(0, 6000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 6007).alias("x"))
    top = windows.top_n_per_group(df, ["g"], [F.asc("x")], 1500)
    assert top.columns == ["g", "x", "rn"]
    for g in (0, 1):
        want = sorted(i * 7919 % 6007 for i in range(g, 6000, 2))[:1500]
        assert [r.x for r in top.where(f"g = {g}").orderBy("rn").collect()] == want


def test_whole_partition_totals(spark):
    df = spark.createDataFrame([(4, "x"), (9, "x"), (7, "y"), (2, None), (8, None)], "id int, category string")
    a = windows.attach_group_totals(df, ["category"], {"total": F.sum("id")})
    assert sorted((r.id, r.total) for r in a.collect()) == [(2, 10), (4, 13), (7, 7), (8, 10), (9, 13)]


def test_bitmap_distinct_with_negatives(spark):
    df = spark.createDataFrame([(-1_700_000_001,), (6,), (6,), (12,), (40_000,), (None,)], "x bigint")
    assert agg.bitmap_count_distinct(df, [], "x").first().n_distinct == 4
    assert agg.distinct_count(df, [], "x").first().n_distinct == 4
    big = spark.range(0, 100_000).select((F.col("id") * 7919 % 65_537 - 30_000).alias("x"))
    want = big.select(F.countDistinct("x")).first()[0]
    assert agg.bitmap_count_distinct(big, [], "x").first().n_distinct == want


def test_dedup_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([("g1", 3, "c"), ("g1", 1, "a"), ("g1", 1, "b"), ("g2", 5, "z")],
                               "guid string, t int, payload string")
    out = agg.dedup_keep_first(df, ["guid"], ["t", "payload"])
    assert sorted(tuple(r) for r in out.collect()) == [("g1", 1, "a"), ("g2", 5, "z")]


def test_avg_all_numeric_and_sum(spark):
    df = spark.createDataFrame([(1, 2, 4.0, "k"), (1, 4, 6.0, "k")], "num int, a int, b double, s string")
    out = agg.avg_all_numeric(df, ["num"]).first()
    assert (out.avg_a, out.avg_b) == (3.0, 5.0) and "avg_s" not in out.asDict()
    s = agg.sum_by_key(df, ["num"], {"t": F.col("a")}, sort=True).first()
    assert s.t == 6


def test_exact_decimal(spark):
    df = spark.createDataFrame([(1.00,)], "x double")
    r = df.select((agg.money("x") - F.lit(9) * agg.money(F.lit(0.10))).alias("d")).first()
    assert str(r.d) == "0.10"


def test_first_by_latest(spark):
    df = spark.createDataFrame([("p", 1, "x"), ("p", 3, "y"), ("q", 2, "z")], "k string, o int, v string")
    out = {r.k: r.v for r in agg.first_by(df, ["k"], ["o"], latest=True).collect()}
    assert out == {"p": "y", "q": "z"}


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5),
                           st.integers(0, 9)), max_size=25)


@settings(max_examples=12, deadline=None)
@given(_ROWS)
def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v int")
    once = agg.dedup_keep_first(df, ["k"], ["t", "v"])
    twice = agg.dedup_keep_first(once, ["k"], ["t", "v"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == len({r[0] for r in rows})


@settings(max_examples=12, deadline=None)
@given(st.lists(_ROWS, min_size=1, max_size=5))
def test_union_count_is_additive(spark, parts):
    from lakeloom.operators.relational import union_many
    dfs = [spark.createDataFrame(p, "k string, t int, v int") for p in parts]
    assert union_many(dfs).count() == sum(len(p) for p in parts)


def test_people_json_inferred_like_read_json(spark):
    from lakeloom.operators.reshape import infer_and_parse
    raw = spark.createDataFrame([(p,) for p in PEOPLE], "value string")
    df = infer_and_parse(raw, [], "value")
    assert df.schema.simpleString() == "struct<age:bigint,name:string>"
    rows = sorted((r.name, r.age) for r in df.collect() if r.age is not None)
    assert len(df.collect()) == 9 and rows[0] == ("ada", 31)
    assert [r.name for r in df.where("age IS NULL").collect()] == ["ada", "ada"]
