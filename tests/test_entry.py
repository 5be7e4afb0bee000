"""Driver contract and the DuckDB oracle at the smallest scale."""

from lakeloom.plans.registry import all_queries
from tests.conftest import SF001
from tests.oracle_harness import compare


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["word", "cnt"] and df.count() > 0


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    assert set(all_queries()) <= set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match_duckdb(spark):
    report = compare(spark, SF001, sorted(all_queries()), verbose=False)
    bad = {k: v for k, v in report.items() if not v.startswith("OK")}
    assert not bad, bad
