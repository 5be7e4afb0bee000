"""Calendar helpers, window validation, interval and range joins against brute force, broadcast bounds."""

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.functions.dates import previous_month
from lakeloom.operators import joins, timeseries


def test_previous_month_and_spine(spark):
    df = spark.createDataFrame([("2018-01-22 00:00:00",), ("2020-03-31 10:00:00",)], "date string")
    got = [r.m for r in df.select(previous_month(F.to_timestamp("date")).alias("m")).collect()]
    assert got == ["2017-12", "2020-02"]
    anchor = spark.createDataFrame([(dt.date(2024, 5, 17),)], "a date")
    spine = [r.month for r in timeseries.month_spine(anchor, "a", 48).collect()]
    assert len(spine) == 49 and spine[0] == "2024-05" and spine[-1] == "2020-05"


def test_slide_must_not_exceed_window():
    import pytest
    with pytest.raises(ValueError):
        timeseries.check_window("5 minutes", "10 minutes")
    timeseries.check_window("10 minutes", "5 minutes")
    timeseries.check_window("1 minute 30 seconds", "500 milliseconds")
    assert timeseries.duration_seconds("1 hour 30 minutes") == 5400
    with pytest.raises(ValueError):
        timeseries.duration_seconds("guid")


def test_interval_join_matches_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    left = [(i, i % 3, base + dt.timedelta(minutes=17 * i)) for i in range(40)]
    right = [(100 + j, j % 3, base + dt.timedelta(minutes=11 * j + 5)) for j in range(60)]
    L = spark.createDataFrame(left, "lid int, k int, lts timestamp")
    R = spark.createDataFrame(right, "rid int, k int, rts timestamp")
    want = {(a, b) for a, ka, ta in left for b, kb, tb in right
            if ka == kb and ta <= tb <= ta + dt.timedelta(hours=1)}
    got = {(r.lid, r.rid) for r in joins.interval_join(L, R, "k", "lts", "rts", 0, 3600).collect()}
    assert got == want
    for width in (600, 7200, 86400):  # any bucket width gives the same pairs
        wide = joins.interval_join(L, R, "k", "lts", "rts", 0, 3600, bucket_s=width).collect()
        assert sorted((r.lid, r.rid) for r in wide) == sorted(want)
    lo = joins.interval_join(L, R, "k", "lts", "rts", 0, 3600, "left").collect()
    matched = {a for a, _ in want}
    assert {(r.lid, r.rid) for r in lo if r.rid is not None} == want
    assert {r.lid for r in lo if r.rid is None} == {a for a, _, _ in left} - matched
    assert len(lo) == len(want) + len({a for a, _, _ in left} - matched)


def test_range_join_matches_brute_force(spark):
    ranges = [(0, 99, "A"), (150, 400, "B"), (70000, 200000, "C")]
    pts = [(i, v) for i, v in enumerate([5, 99, 100, 150, 400, 401, 70000, 131072, 199999, 250000])]
    R = spark.createDataFrame(ranges, "lo bigint, hi bigint, name string")
    P = spark.createDataFrame(pts, "id int, p bigint")
    got = {(r.id, r.name) for r in joins.range_join(P, R, "p", "lo", "hi", bucket_bits=8).collect()}
    want = {(i, next((n for lo, hi, n in ranges if lo <= v <= hi), None)) for i, v in pts}
    assert got == want


def test_range_join_bounds_wide_ranges(spark):
    """Ranges of any width explode into few rows; levels mix in one join."""
    ranges = [(0, 99, "A"), (-5, 2**62, "wide"), (-2**63, 2**63 - 1, "all"), (70000, 200000, "C")]
    pts = [(i, v) for i, v in enumerate([-2**63, -6, -5, 0, 99, 100, 70000, 2**62, 2**62 + 1, 2**63 - 1])]
    R = spark.createDataFrame(ranges, "lo bigint, hi bigint, name string")
    P = spark.createDataFrame(pts, "id int, p bigint")
    got = sorted((r.id, r.name) for r in joins.range_join(P, R, "p", "lo", "hi", bucket_bits=8).collect())
    assert got == sorted((i, n) for i, v in pts for lo, hi, n in ranges if lo <= v <= hi)
    few = R.where("name IN ('A', 'wide')")
    got = sorted((r.id, str(r.name)) for r in joins.range_join(P, few, "p", "lo", "hi", bucket_bits=8).collect())
    want = [(i, n) for i, v in pts for lo, hi, n in ranges[:2] if lo <= v <= hi]
    assert got == sorted(want + [(i, "None") for i, _ in pts if i not in {j for j, _ in want}])


def test_ip_codec(spark):
    df = spark.createDataFrame([("59.39.129.163",), ("1.2.3",), ("256.1.1.1",), (None,)], "ip string")
    got = [r.n for r in df.select(joins.ip_to_long("ip").alias("n")).collect()]
    assert got == [59 * 2**24 + 39 * 2**16 + 129 * 256 + 163, None, None, None]
    back = df.select(joins.long_to_ip(joins.ip_to_long("ip")).alias("x")).first().x
    assert back == "59.39.129.163"


def test_broadcast_if_small(spark):
    small = spark.range(10)
    big = spark.range(1000)
    j1 = spark.range(100).join(joins.broadcast_if_small(small, 100), "id")
    j2 = spark.range(100).join(joins.broadcast_if_small(big, 100), "id")
    assert j1.count() == 10 and j2.count() == 100


def test_broadcast_bound_uses_measured_bytes(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    wide = spark.range(1000).selectExpr("id", "repeat('x', 2000) AS s")  # ~2 MB of text
    assert hinted(joins.broadcast_if_small(wide, 10_000))
    # 1000 rows fit the row bound, but 2 MB of strings exceed a 1 MB byte bound
    assert not hinted(joins.broadcast_if_small(wide, 10_000, max_bytes=1_000_000))
    assert not hinted(joins.broadcast_if_small(wide, 999))


def test_interval_join_edges_at_bucket_borders(spark):
    # pairs exactly at the interval edges, with left times on bucket borders
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    us = dt.timedelta(microseconds=1)
    left = [(1, 1, base), (2, 1, base - us), (3, 1, base + dt.timedelta(hours=1) - us)]
    right = [(10, 1, base), (11, 1, base + dt.timedelta(hours=1)), (12, 1, base + dt.timedelta(hours=1) - us),
             (13, 1, base + dt.timedelta(hours=2) - us), (14, 1, base + dt.timedelta(hours=2))]
    L = spark.createDataFrame(left, "lid int, k int, lts timestamp")
    R = spark.createDataFrame(right, "rid int, k int, rts timestamp")
    want = {(a, b) for a, _, ta in left for b, _, tb in right
            if ta <= tb <= ta + dt.timedelta(hours=1)}
    got = {(r.lid, r.rid) for r in joins.interval_join(L, R, "k", "lts", "rts", 0, 3600).collect()}
    assert got == want and (3, 13) in want and (1, 11) in want


def test_interval_join_ntz_ignores_session_dst(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        L = spark.createDataFrame([(1, 1, "2024-11-03 01:59:00")], "lid int, k int, s string") \
            .selectExpr("lid", "k", "CAST(s AS TIMESTAMP_NTZ) AS lts")
        R = spark.createDataFrame([(9, 1, "2024-11-03 02:50:00")], "rid int, k int, s string") \
            .selectExpr("rid", "k", "CAST(s AS TIMESTAMP_NTZ) AS rts")
        got = [(r.lid, r.rid) for r in joins.interval_join(L, R, "k", "lts", "rts", 0, 3600).collect()]
        assert got == [(1, 9)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
