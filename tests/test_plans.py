"""Physical-plan properties the design relies on (checked with explain)."""

from candlestack.operators import bars as B
from candlestack.operators import periods as P
from candlestack.operators import rolling as R
from candlestack.plans.queries import QUERIES, bars
from candlestack.sources.tables import read_table
from conftest import SF_SMOKE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_aggregate_is_over_ticks_is_hash_based(spark):
    # the aggregate over the ticks; the few parts of a bar are merged by struct
    over_ticks = [x for x in plan(bars(spark, SF_SMOKE)).splitlines()
                  if "partial_min_by(l_extendedprice" in x]
    assert over_ticks and all("HashAggregate" in x for x in over_ticks)
    li = read_table(spark, SF_SMOKE, "lineitem")
    assert "SortAggregate" in plan(B.bars_from_ticks(li))   # struct tie-break fallback


def test_scan_prunes_columns_and_pushes_date_filter(spark):
    p = plan(QUERIES["date_range"](spark, SF_SMOKE))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    wc = plan(QUERIES["word_count"](spark, SF_SMOKE))
    assert "ReadSchema: struct<text:string>" in wc


def test_grouping_sets_read_bars_once(spark):
    b = bars(spark, SF_SMOKE)
    p = plan(P.period_stats_long(b))
    assert p.count("Expand") == 1
    assert p.count("FileScan parquet") == 1


def test_rolling_windows_partition_by_segment(spark):
    p = plan(R.rolling_analytics(bars(spark, SF_SMOKE)))
    assert "hashpartitioning(symbol" in p and "_seg" in p
    # the only single-partition exchange is the per-sort-partition offsets
    assert p.count("SinglePartition") <= 1


def test_landed_range_prunes_year_folders(spark):
    p = plan(QUERIES["date_range_landed"](spark, SF_SMOKE))
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p
    assert "PushedFilters: [IsNotNull(Date), GreaterThanOrEqual(Date,1998-01-01)" in p


def test_bounded_series_use_one_window_per_symbol(spark):

    b = bars(spark, SF_SMOKE)
    small = plan(R.rolling_analytics(b, bounded=True))
    assert "_seg" not in small and "hashpartitioning(symbol" in small
    big = plan(R.rolling_analytics(b))
    assert "_seg" in big


def test_changelog_read_after_compaction_prunes_old_batches(spark, tmp_dir):
    from candlestack.sinks import upsert as U

    log = U.ChangeLog(f"{tmp_dir}/t", ["k"])
    mk = lambda rows: spark.createDataFrame(rows, "k string, x double")
    for i in range(3):
        log.write_batch(mk([("A", float(i))]), i)
    log.compact(spark)
    log.write_batch(mk([("B", 9.0)]), 3)
    p = plan(log.read(spark))
    assert "_batch=3" in p and not any(f"_batch={i}" in p for i in range(3))
