"""Split scans, region files, the cell source, shipped lookups, stored bitmaps, arrays cut at marks."""

import bisect
import collections
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import aggregate, bulk, joins, kv, lookup, reshape, splits
from lakeloom.sources import cells as cell_source
from lakeloom.streaming.recovery import session_conf


def test_every_row_falls_in_one_stride(spark):
    """Nulls and values far outside the bounds too."""
    values = [None, None, -10 ** 18, -1, 0, 1, 5, 9, 10, 99, 100, 101, 10 ** 18]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for lower, upper, n in ((0, 100, 7), (0, 3, 10), (-5, 5, 1), (90, 10 ** 17, 3)):
        parts = splits.stride("v", lower, upper, n)
        splits.prove(df, parts)
        got = splits.scan(df, parts, proved=True)
        assert sorted(str(r.v) for r in got.collect()) == sorted(map(str, values))
        assert got.select("split").distinct().count() <= min(n, upper - lower)
    with pytest.raises(ValueError):
        splits.stride("v", 5, 5, 2)


def test_gaps_and_overlaps_raise(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    splits.prove(df, splits.by_predicates(["v < 3", "v >= 3 OR v IS NULL"]))
    for bad in (["v < 3", "v >= 3"], ["v < 3", "v > 0 OR v IS NULL"], ["v < 3 OR v IS NULL"], []):
        with pytest.raises(ValueError):
            splits.scan(df, splits.by_predicates(bad))
    splits.prove(df.limit(0), [])


def test_split_scans_push_their_conditions_down(spark, tmp):
    spark.range(1000).write.parquet(f"{tmp}/t")
    plan = splits.scan(spark.read.parquet(f"{tmp}/t"), splits.stride("id", 0, 1000, 4), proved=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedFilters: [") == 4 and "GreaterThanOrEqual(id,250)" in text


def _cells(spark, keys):
    return spark.createDataFrame([(k, "f", f"q{i}", 0, str(i)) for i, k in enumerate(keys)],
                                 "row_key string, family string, qualifier string, version bigint, value string")


def test_region_files_keep_their_borders_and_order(spark, tmp):
    """Keys at, below and beyond the splits, an empty region, a hot one that is cut further."""
    rng = random.Random(1)
    keys = ["a", "m", "m", "lzz", "m0", "zz", "", "é", "s"] + [f"h{rng.randrange(10 ** 6):06d}" for _ in range(600)] + ["hot"] * 200
    given = ["b", "m", "n", "n5", "s"]
    manifest = bulk.write(_cells(spark, keys).repartition(5), f"{tmp}/b", given, max_cells=100).orderBy("region").collect()
    assert sum(r.cells for r in manifest) == len(keys) and len(manifest) > 8
    assert len({r.region for r in manifest}) == len(manifest)
    for a, b in zip(manifest, manifest[1:]):
        assert a.last_key < b.first_key and a.upper <= b.lower
    # Regions over the limit hold a single key; the given borders are all kept.
    assert [r.first_key for r in manifest if r.cells > 110] == ["hot"]
    cuts = {r.lower for r in manifest} | {r.upper for r in manifest}
    assert {"b", "m", "n", "s"} <= cuts
    rows = bulk.read(spark, f"{tmp}/b")
    assert rows.drop("region").exceptAll(_cells(spark, keys)).count() == 0 and rows.count() == len(keys)
    for r in manifest:
        own = [x.row_key for x in spark.read.parquet(r.file).collect()]
        assert own == sorted(own)


def test_regions_are_found_among_thousands_of_splits(spark):
    """Keys at, between and beyond the splits, and none; thousands of hot spans in one round."""
    every = [f"{i:05d}" for i in range(20_000)] + ["é", "\U0001F600", '"\\']
    keys = spark.createDataFrame([(k,) for k in every + [None]], "row_key string")
    for splits_ in ([], ["00007"], every[3::5], sorted(every)):
        got = keys.select("row_key", bulk.region_of(F.col("row_key"), splits_).alias("r")).collect()
        assert all(r.r == (0 if r.row_key is None else bisect.bisect_right(splits_, r.row_key)) for r in got)
    counts = spark.createDataFrame([(k, 1) for k in every[:20_000]], "row_key string, n bigint")
    cuts = bulk.hot_splits(counts, [], 5)
    held = collections.Counter(bisect.bisect_right(cuts, k) for k in every[:20_000])
    assert set(held.values()) == {5} and len(held) == len(cuts) + 1 == 4000


def test_cells_are_read_twice_however_many_rounds_the_cuts_take(spark, tmp):
    """Once for the counts of the keys, once for the files."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    cells = _cells(spark, [f"k{i % 500:05d}" for i in range(1000)])
    manifest = bulk.write(cells.mapInArrow(count, cells.schema), f"{tmp}/r", [], max_cells=100)
    assert manifest.agg(F.sum("cells")).first()[0] == 1000 and manifest.count() >= 10
    assert seen.value <= 2 * 1000


def test_bulk_inputs_that_cannot_be_placed_raise(spark, tmp):
    with pytest.raises(ValueError):
        bulk.write(_cells(spark, ["a", None]), f"{tmp}/n", ["b"])
    with pytest.raises(ValueError):
        bulk.write(_cells(spark, ["a"]), f"{tmp}/s", ["b", "a"])
    assert bulk.write(_cells(spark, []), f"{tmp}/e", ["b"]).count() == 0


def test_the_cell_source_reads_only_regions_that_overlap(spark, tmp):
    keys = [f"k{i:03d}" for i in range(100)]
    bulk.write(_cells(spark, keys), f"{tmp}/c", ["k020", "k040", "k060", "k080"])
    with session_conf(spark, cell_source.PUSHDOWN):
        cells = cell_source.regions(spark, f"{tmp}/c")
        assert cells.rdd.getNumPartitions() == 5 and cells.count() == 100
        for cond, regions, n in ((kv.range_scan(cells, "k030", "k050"), 2, 20), (kv.get(cells, "k061"), 1, 1),
                                 (cells.where("row_key IN ('k001', 'k099', 'none')"), 2, 2),
                                 (cells.where("row_key LIKE 'k08%'"), 1, 10), (kv.get(cells, "zzz"), 1, 0),
                                 (cells.where("value = '7'"), 5, 1)):
            assert cond.rdd.getNumPartitions() == regions
            assert cond.count() == n
        # Rows read by the source, before Spark's filter: two regions of twenty.
        plan = kv.range_scan(cells, "k030", "k050")
        assert plan.count() == 20 and "row_key" in plan._jdf.queryExecution().executedPlan().toString()


def test_the_narrowest_range_wins():
    plain = lambda rs, x: min(((hi - lo, lo, label) for lo, hi, label in rs if lo <= x <= hi), default=(0, 0, None))[2]
    rng = random.Random(3)
    for _ in range(200):
        rs = [(a, a + rng.randrange(-2, 30), rng.choice("abcd")) for a in (rng.randrange(60) for _ in range(rng.randrange(12)))]
        cut = lookup.segments(rs)
        assert all(a[1] < b[0] for a, b in zip(cut, cut[1:]))
        for x in range(-2, 95):
            assert next((s[2] for s in cut if s[0] <= x <= s[1]), None) == plain(rs, x), (rs, x)
    assert lookup.segments([(None, 3, "a"), (4, None, "b"), (9, 8, "c")]) == []


def test_shipped_lookup(spark, monkeypatch):
    ranges = spark.createDataFrame([(0, 100, "wide", "x"), (10, 20, "mid", None), (12, 13, None, "z"), (None, 5, "bad", "bad")],
                                   "lo bigint, hi bigint, name string, more string")
    pts = spark.createDataFrame([(i,) for i in (None, -1, 0, 10, 12, 14, 21, 100, 101)], "p bigint")
    got = {r.p: (r.name, r.more) for r in lookup.shipped_lookup(pts, ranges, "p", "lo", "hi", ["name", "more"]).collect()}
    assert got == {None: (None, None), -1: (None, None), 0: ("wide", "x"), 10: ("mid", None), 12: (None, "z"),
                   14: ("mid", None), 21: ("wide", "x"), 100: ("wide", "x"), 101: (None, None)}
    none = lookup.shipped_lookup(pts, ranges.limit(0), "p", "lo", "hi", ["name"]).where("name IS NOT NULL")
    assert none.count() == 0
    with pytest.raises(ValueError):
        lookup.shipped_lookup(pts, ranges, "p", "lo", "hi", ["p"])
    monkeypatch.setattr(lookup, "MOST_RANGES", 2)
    with pytest.raises(ValueError):
        lookup.shipped_lookup(pts, ranges, "p", "lo", "hi", ["name"])


def test_stored_bitmaps_roll_up(spark):
    rng = random.Random(5)
    rows = [(d, rng.choice([None, -5, 0, 40_000, 10 ** 12]) if rng.random() < 0.2 else rng.randrange(300)) for d in range(20) for _ in range(50)]
    df = spark.createDataFrame(rows, "d int, v bigint")
    stored = aggregate.bitmaps(df, ["d"], "v")
    got = {r._k0: r.n_distinct for r in aggregate.rolled_up(stored, [F.floor(F.col("d") / 7)]).collect()}
    assert got == {w: len({v for d, v in rows if d // 7 == w and v is not None}) for w in range(3)}
    assert aggregate.rolled_up(stored.limit(0), [F.col("d")]).count() == 0


def test_arrays_cut_at_marks(spark):
    df = spark.createDataFrame([(1, '[{"name":"a,b","phone":"1"} , {"name":"c]","phone":"2"}]'), (2, "[]"), (3, None),
                                (4, ' [{"name":"only"}] ')], "id int, j string")
    rows = reshape.explode_json_marks(df, ["id"], "j").select(
        "id", reshape.field_by_marks("element", "name").alias("name"), reshape.field_by_marks("element", "phone").alias("phone"))
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, "a,b", "1"), (1, "c]", "2"), (4, "only", None)]
    assert joins.ip_to_long(F.lit("1.2.3.4")) is not None
