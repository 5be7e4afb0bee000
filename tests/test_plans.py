"""Physical-plan guards: what must (and must not) appear at any scale."""

import pytest

from lakeloom.tables import load
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark):
    import __spark_entry__ as E
    from lakeloom.plans.registry import all_queries
    own = all_queries()
    return {name: fn(spark, SF001) for name, fn in E.queries().items() if name in own}


def test_no_query_plans_all_pairs(built):
    bad = {n: [f for f in FORBIDDEN if f in plan(df)] for n, df in built.items()}
    assert not {n: f for n, f in bad.items() if f}


def test_filters_and_columns_reach_the_scan(built, spark):
    p = plan(built["scan_parquet"])
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p
    late = load(spark, SF001, "orders").where("o_orderdate >= TIMESTAMP_NTZ'2000-01-01'").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan(late)
    assert "ReadSchema: struct<text:string>" in plan(built["word_count"])


def test_top_n_limits_before_the_shuffle(built):
    p = built["top_n_per_group"]._jdf.queryExecution().sparkPlan().toString()
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_aggregations_are_partial(built):
    for name in ("word_count", "sum_by_key", "count_by_group", "sliding_count", "latest_cell"):
        p = built[name]._jdf.queryExecution().sparkPlan().toString()
        assert "partial_" in p, name


def test_group_totals_join_not_window(built):
    p = plan(built["window_partition_total"])
    assert "Window" not in p.replace("WindowGroupLimit", "")


def _formatted(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_bucketed_cells_need_no_shuffle(built):
    rows = built["cells_to_rows_bucketed"]
    rows.collect()
    assert "Exchange hashpartitioning" not in plan(rows)
    get = built["kv_get_bucketed"]
    get.collect()
    assert "Exchange" not in plan(get)
    assert "SelectedBucketsCount: 1 out of" in _formatted(get)
