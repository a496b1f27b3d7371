"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMOKE
from oracle_compare import compare, duck

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle_or_is_rows_only():
    # the training-data queries (opN_, pipeline) have tests of their own
    rows_only = {q for q in set(QUERIES) - set(ORACLE)
                 if not (q.startswith("op") and "_" in q and q[2:q.index("_")].isdigit())
                 and q != "pipeline"}
    assert rows_only == {"preview_lines"}
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == E.entry(spark).columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    problems = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert not problems, problems


def test_preview_is_the_beginning_of_the_file(spark):
    rows = [r.value for r in QUERIES["preview_lines"](spark, SF_SMOKE).collect()]
    assert len(rows) == 5 and rows[0].startswith("symbol,Date,Open")


TIE_PRONE = ["monthly_stats", "quarterly_stats", "yearly_stats", "yoy_growth",
             "period_stats_long", "to_documents", "to_points_stats", "null_normalise",
             "describe_exact", "summary_stats", "monthly_analysis", "page_stats",
             "describe_last_n_days", "period_stats_from_landed", "daily_return",
             "volatility_20", "price_movement", "headline_stats"]


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMOKE)


@pytest.mark.parametrize("name", TIE_PRONE)
def test_rounded_means_match_at_small_scale(spark, con_small, name):
    # Few rows per period make exact halves likely: means must be exact.
    problems = compare(QUERIES[name](spark, SF_SMOKE), con_small, ORACLE[name])
    assert not problems, problems
