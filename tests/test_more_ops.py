"""Further operator edge cases: global cell order, describe with nulls, windows, fixture goldens."""

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.operators import joins, kv, reshape, timeseries
from lakeloom.operators.relational import describe_schema


def test_sorted_cells_are_globally_ordered(spark):
    rows = [(f"{(i * 7919) % 1000:04d}", "cf", q, 0, str(i)) for i in range(300) for q in ("b", "a")]
    cells = spark.createDataFrame(rows, "row_key string, family string, qualifier string, "
                                        "version bigint, value string")
    out = [(r.row_key, r.qualifier) for r in reshape.sorted_cells(cells, 7).collect()]
    assert out == sorted(out) and len(out) == 600


def test_describe_schema_counts_non_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, "y")], "a int, b string")
    got = {r.col_name: (r.data_type, r.non_null) for r in describe_schema(df).collect()}
    assert got == {"a": ("int", 2), "b": ("string", 2)}


def test_upsert_without_order(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in kv.upsert(target, changes, ["k"]).collect()) == [
        (1, "a"), (2, "B"), (3, "C")]


def test_tumbling_and_sliding_counts(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t0 + dt.timedelta(minutes=m), "x") for m in (0, 4, 6, 11)],
                               "ts timestamp, k string")
    tumb = {r.window_start.minute: r.cnt for r in
            timeseries.windowed_count(df, "ts", ["k"], "5 minutes").collect()}
    assert tumb == {0: 2, 5: 1, 10: 1}
    slide = {(r.window_start.hour, r.window_start.minute): r.cnt for r in
             timeseries.windowed_count(df, "ts", ["k"], "10 minutes", "5 minutes").collect()}
    assert slide == {(23, 55): 2, (0, 0): 3, (0, 5): 2, (0, 10): 1}


def test_range_join_inner_drops_unmatched(spark):
    R = spark.createDataFrame([(10, 20, "A")], "lo bigint, hi bigint, name string")
    P = spark.createDataFrame([(1, 15), (2, 25)], "id int, p bigint")
    got = [(r.id, r.name) for r in joins.range_join(P, R, "p", "lo", "hi", 2, how="inner").collect()]
    assert got == [(1, "A")]


def test_arith_and_even_filter(spark):
    from lakeloom.operators.relational import where, with_exprs
    df = spark.createDataFrame([(x,) for x in (-6, 0, 7, 250, 99_999_999)], "x int")
    assert [r.y for r in with_exprs(df, {"y": "x + 1"}).collect()] == [-5, 1, 8, 251, 100_000_000]
    assert [r.x for r in where(df, "x % 2 = 0").collect()] == [-6, 0, 250]


def test_words_of_a_cell_explode_to_rows(spark):
    from lakeloom.operators.text import explode_split
    df = spark.createDataFrame([(12, "sanding gluing varnish"), (13, "")], "num int, tasks string")
    out = [(r.num, r.token) for r in explode_split(df, ["num"], "tasks", " ").collect()]
    assert out[:3] == [(12, "sanding"), (12, "gluing"), (12, "varnish")]


def test_monthly_counts_ignore_null_times(spark):
    df = spark.createDataFrame([("2024-01-05",), (None,), ("2024-03-01",)], "d string") \
        .selectExpr("CAST(d AS TIMESTAMP) AS ts")
    got = {r.month: r.cnt for r in timeseries.monthly_counts_filled(df, "ts", 2).collect()}
    assert got == {"2024-03": 1, "2024-02": 0, "2024-01": 1}
