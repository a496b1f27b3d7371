"""Segmented series windows equal plain series-wide windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlestack.operators import rolling as R
from candlestack.operators.series import halo_segments, position_index, series_columns


def _bars(spark, n_per_symbol, symbols=("A", "B", "C"), seed=7):
    rnd = random.Random(seed)
    rows = []
    for s in symbols:
        d = dt.date(2019, 12, 20)
        for _ in range(n_per_symbol):
            d += dt.timedelta(days=rnd.choice([1, 1, 1, 2, 3, 40]))
            o = round(rnd.uniform(10, 100), 2)
            c = round(o * rnd.uniform(0.9, 1.1), 2)
            rows.append((s, d, o, max(o, c) + 1, min(o, c) - 1, c, c, rnd.randint(1, 1000)))
    return spark.createDataFrame(
        rows, "symbol string, Date date, Open double, High double, Low double, "
              "Close double, `Adj Close` double, Volume long")


def test_position_index_is_row_number(spark):
    bars = _bars(spark, 150)
    got = position_index(bars, ["symbol"], ["Date"])
    w = Window.partitionBy("symbol").orderBy("Date")
    want = bars.withColumn("_pos", F.row_number().over(w) - 1)
    assert sorted(got.select("symbol", "Date", "_pos").collect()) == \
        sorted(want.select("symbol", "Date", "_pos").collect())


def test_global_position_index(spark):
    bars = _bars(spark, 60)
    got = position_index(bars, [], ["symbol", "Date"])
    rows = sorted(got.select("symbol", "Date", "_pos").collect(), key=lambda r: r._pos)
    assert [r._pos for r in rows] == list(range(180))
    assert [(r.symbol, r.Date) for r in rows] == sorted((r.symbol, r.Date) for r in rows)


def test_halo_copies_exactly_the_tail(spark):
    df = spark.range(0, 23).withColumnRenamed("id", "_g")
    segs = halo_segments(df, halo=3, seg_rows=10).collect()
    halo = sorted((r._g, r._seg) for r in segs if r._halo)
    assert halo == [(7, 1), (8, 1), (9, 1), (17, 2), (18, 2), (19, 2)]
    assert len([r for r in segs if not r._halo]) == 23


@pytest.mark.parametrize("seg_rows", [1, 7, 20, 33, 10_000])
def test_rolling_equals_plain_window(spark, seg_rows):
    bars = _bars(spark, 120)
    got = R.rolling_analytics(bars, seg_rows=seg_rows)
    w = Window.partitionBy("symbol").orderBy("Date")
    prev = F.lag("Close").over(w)
    f5, f20 = w.rowsBetween(-4, 0), w.rowsBetween(-19, 0)
    want = (bars.withColumn("Daily Return", (F.col("Close") - prev) / prev)
            .withColumn("MA5", F.when(F.count("Close").over(f5) == 5, F.avg("Close").over(f5)))
            .withColumn("MA20", F.when(F.count("Close").over(f20) == 20,
                                       F.avg("Close").over(f20)))
            .withColumn("Volatility", F.when(
                F.count("Daily Return").over(f20) == 20,
                F.stddev_samp("Daily Return").over(f20) * F.sqrt(F.lit(252.0)))))
    cols = ["symbol", "Date", "Daily Return", "MA5", "MA20", "Volatility"]

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in df.select(*cols).collect())

    assert rows(got) == rows(want)
    assert got.count() == bars.count()


def test_series_columns_rejects_nothing_with_zero_halo(spark):
    bars = _bars(spark, 30)
    out = series_columns(bars, ["symbol"], ["Date"], 0,
                         lambda w: [{"rn": F.row_number().over(w)}], seg_rows=8)
    assert out.count() == 90


@pytest.fixture
def many_partitions(spark):
    """Keep 8 un-coalesced shuffle partitions so sorts span several tasks."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_hot_series_spans_partitions(spark, many_partitions):
    # One symbol with 95% of the rows: its sort range is split over tasks.
    bars = _bars(spark, 400, symbols=("HOT",), seed=1).unionByName(_bars(spark, 20, ("a",), 2))
    idx = position_index(bars, ["symbol"], ["Date"])
    parts = {r._pos: r for r in idx.where("symbol = 'HOT'").collect()}
    assert sorted(parts) == list(range(400))
    from candlestack.operators.series import sorted_partitions
    pids = sorted_partitions(bars, ["symbol", "Date"]).where("symbol = 'HOT'") \
        .select("_pid").distinct().count()
    assert pids > 1
    got = R.rolling_analytics(bars, seg_rows=50)
    w = Window.partitionBy("symbol").orderBy("Date")
    f20 = w.rowsBetween(-19, 0)
    want = bars.withColumn("MA20", F.when(F.count("Close").over(f20) == 20,
                                          F.avg("Close").over(f20)))

    def rows(df):
        return sorted((r.symbol, r.Date, None if r.MA20 is None else round(r.MA20, 9))
                      for r in df.select("symbol", "Date", "MA20").collect())

    assert rows(got) == rows(want)


def test_empty_and_null_inputs(spark):
    from candlestack.operators.quantiles import exact_quantiles

    empty = _bars(spark, 5).limit(0)
    assert R.rolling_analytics(empty).count() == 0
    assert position_index(empty, ["symbol"], ["Date"]).count() == 0
    nulls = spark.createDataFrame([("a", None), ("a", None)], "k string, v double")
    assert exact_quantiles(nulls, ["k"], "v", [0.5]).count() == 0
    keyed = spark.createDataFrame([(None, 1), (None, 2), ("x", 3)], "k string, v long")
    pos = sorted((r.k, r.v, r._pos) for r in position_index(keyed, ["k"], ["v"]).collect()
                 if r.k is None)
    assert pos == [(None, 1, 0), (None, 2, 1)]


def test_tick_series_equals_plain_window_on_driver_data(spark):
    # Every lineitem tick as one series per flag (~20k rows each at sf0.01),
    # cut into 2,000-row segments: equal to the one-task-per-flag window.
    from conftest import SF_ORACLE
    from candlestack.sources.tables import read_table

    li = read_table(spark, SF_ORACLE, "lineitem").select(
        "l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        "l_suppkey", "l_extendedprice")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    got = series_columns(li, ["l_returnflag"], order, 9,
                         lambda w: [{"ma": F.avg("l_extendedprice").over(w.rowsBetween(-9, 0)),
                                     "prev": F.lag("l_extendedprice").over(w)}],
                         seg_rows=2_000)
    w = Window.partitionBy("l_returnflag").orderBy(*order)
    want = li.withColumns({"ma": F.avg("l_extendedprice").over(w.rowsBetween(-9, 0)),
                           "prev": F.lag("l_extendedprice").over(w)})
    diff = got.select(*want.columns).exceptAll(want.select(*want.columns))
    assert got.count() == want.count() == 60_000
    assert diff.count() == 0


def test_bounded_path_equals_segmented_path(spark):
    bars = _bars(spark, 90)
    cols = ["symbol", "Date", "Daily Return", "MA5", "MA20", "Volatility"]

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in df.select(*cols).collect())

    assert rows(R.rolling_analytics(bars, bounded=True)) == \
        rows(R.rolling_analytics(bars, seg_rows=17))
