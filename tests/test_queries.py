"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check, smaller)."""

import pytest

import __spark_entry__ as E
from tests.harness import compare, duckdb_con

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.queries())
# Fixed-key lookups whose key may be absent from the tiny sf0.001 tables.
POINT_LOOKUPS = {"a10_metrics_lookup", "l2_l4_lookups", "w16_w18_lookups"}


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert r["status"] in ("ok", "rows-only"), r
    if name not in POINT_LOOKUPS:
        assert r["spark_rows"] > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["week_start_date", "board_key", "term", "post_hits", "total_posts",
                          "appearance_rate", "zscore", "rank"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["w7_weekly_trends", "w16_w18_lookups", "w21_weekly_summary", "w20_quarantine", "w20_error_reasons", "i1_checks"])
def test_weekly_queries_read_the_posts_once(spark, monkeypatch, name):
    from wordtide.plans import pipeline as P

    names, kept = [], P.stage
    monkeypatch.setattr(P, "stage", lambda df, what: names.append(what) or kept(df, what))
    E.queries()[name](spark, SF)
    assert sorted(names) == ["dictionary", "term-counts"]  # no second pass for the days or the metrics
