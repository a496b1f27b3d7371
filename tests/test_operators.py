"""Hand-written edge fixtures with known answers (FIXTURES.md section 4)."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlestack.operators import bars as B
from candlestack.operators import logs as L
from candlestack.operators import paging as G
from candlestack.operators import periods as P
from candlestack.operators import rolling as R
from candlestack.operators import stats as S
from candlestack.schemas import BAR, BAR_CSV
from candlestack.sinks import upsert as U
from candlestack.sources import csv as CSV

BAR_DDL = ("symbol string, Date date, Open double, High double, Low double, Close double, "
           "`Adj Close` double, Volume long")


def bar(symbol, d, o, c, v=100, h=None, lo=None):
    return (symbol, d, float(o), float(h if h is not None else max(o, c)),
            float(lo if lo is not None else min(o, c)), float(c), float(c), v)


def series(spark, n, symbol="A", start=dt.date(2020, 1, 1)):
    rows = [bar(symbol, start + dt.timedelta(days=i), 10 + i, 11 + i + (i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, BAR_DDL)


def test_bars_from_ticks_open_close_by_order(spark):
    ticks = spark.createDataFrame(
        [("A", dt.datetime(2020, 1, 1, 9), 1, 1, 1, 1, 5.0, 10.0),
         ("A", dt.datetime(2020, 1, 1, 10), 2, 1, 1, 1, 7.0, 12.0),
         ("A", dt.datetime(2020, 1, 1, 10), 3, 1, 1, 1, 3.0, 11.0),
         ("B", dt.datetime(2020, 1, 1, 12), 4, 1, 1, 1, 2.0, 99.0)],
        "l_returnflag string, l_shipdate timestamp_ntz, l_orderkey long, l_linenumber int, "
        "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double")
    got = {r.symbol: r for r in B.bars_from_ticks(ticks).collect()}
    a = got["A"]
    assert (a.Open, a.High, a.Low, a.Close, a.Volume) == (10.0, 12.0, 10.0, 11.0, 15)
    assert a["Adj Close"] == 11.0 and a.Date == dt.date(2020, 1, 1)
    assert got["B"].Open == got["B"].Close == 99.0


def test_zero_open_gives_null_return(spark):
    df = spark.createDataFrame([bar("A", dt.date(2020, 1, 1), 0, 1)], BAR_DDL)
    r = B.derived_columns(df).collect()[0]
    assert r.Return is None and r["Close Pct Change"] is None and r["AVG Price"] == 0.5


def test_split_adjust_leaves_volume(spark):
    df = spark.createDataFrame([bar("A", dt.date(2020, 1, 1), 40, 60, v=7)], BAR_DDL)
    r = B.split_adjust(df, 20).collect()[0]
    assert (r.Open, r.Close, r["Adj Close"], r.Volume) == (2.0, 3.0, 3.0, 7)


def test_single_day_month(spark):
    df = spark.createDataFrame([bar("A", dt.date(2020, 2, 3), 5, 6)], BAR_DDL)
    r = P.monthly_stats(df).collect()[0]
    assert r.Month == "2020-02" and r.Trading_Days == 1 and r.Std_Close is None


def test_yoy_compares_with_previous_present_year(spark):
    df = spark.createDataFrame([bar("A", dt.date(2019, 5, 1), 1, 100),
                                bar("A", dt.date(2021, 5, 1), 1, 150)], BAR_DDL)
    got = {r.Year: r.YoY_Growth for r in P.yearly_stats(df).collect()}
    assert got[2019] is None and got[2021] == pytest.approx(50.0)


def test_period_levels_agree(spark):
    df = series(spark, 400)
    long = P.period_stats_long(df)
    sums = {r.period_type: (r.d, r.v) for r in long.groupBy("period_type").agg(
        F.sum("Trading_Days").alias("d"), F.sum("Total_Volume").alias("v")).collect()}
    assert sums["monthly"] == sums["quarterly"] == sums["yearly"] == (400, 40000)
    starts = {r.period: r.period_start for r in long.collect()}
    assert starts["2020-Q2"] == dt.date(2020, 4, 1)
    assert starts["2020-03"] == dt.date(2020, 3, 1) and starts["2021"] == dt.date(2021, 1, 1)


@pytest.mark.parametrize("n", [4, 5, 20, 21])
def test_rolling_warm_up(spark, n):
    rows = sorted(R.rolling_analytics(series(spark, n)).collect(), key=lambda r: r.Date)
    assert rows[0]["Daily Return"] is None
    ma5 = [r.MA5 is not None for r in rows]
    ma20 = [r.MA20 is not None for r in rows]
    vol = [r.Volatility is not None for r in rows]
    assert ma5 == [i >= 4 for i in range(n)]
    assert ma20 == [i >= 19 for i in range(n)]
    assert vol == [i >= 20 for i in range(n)]


def test_rolling_matches_pandas(spark):
    df = series(spark, 60)
    got = R.rolling_analytics(df).orderBy("Date").toPandas()
    pdf = df.orderBy("Date").toPandas()
    ret = pdf["Close"].pct_change()
    assert got["Daily Return"].iloc[1:].round(12).tolist() == ret.iloc[1:].round(12).tolist()
    pd.testing.assert_series_equal(got["MA5"], pdf["Close"].rolling(5).mean(),
                                   check_names=False)
    pd.testing.assert_series_equal(got["MA20"], pdf["Close"].rolling(20).mean(),
                                   check_names=False)
    pd.testing.assert_series_equal(got["Volatility"], ret.rolling(20).std() * 252 ** 0.5,
                                   check_names=False)


def test_two_symbols_do_not_leak(spark):
    a = series(spark, 10, "A")
    b = series(spark, 10, "B").withColumn("Close", F.col("Close") * 100)
    rows = R.rolling_analytics(a.unionByName(b)).where("symbol = 'B'").orderBy("Date").collect()
    assert rows[0]["Daily Return"] is None
    assert all(r.MA5 is None or r.MA5 > 500 for r in rows)


def test_describe_exact_matches_pandas(spark):
    df = series(spark, 37)
    got = {r.statistic: r.Close for r in S.describe_exact(df).collect()}
    want = df.toPandas()["Close"].describe()
    for k in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
        assert got[k] == pytest.approx(want[k])


def test_paging_pages_of_5_5_2(spark):
    df = series(spark, 12)
    sizes = [G.page(df, n, 5).count() for n in range(4)]
    assert sizes == [5, 5, 2, 0]
    deep = [G.page(df, n, 5).count() for n in range(4)]
    assert deep == sizes
    stats = sorted(G.page_stats(df, 5).collect(), key=lambda r: r.page)
    assert [r.Rows for r in stats] == [5, 5, 2]
    assert stats[1].Start_Date == dt.date(2020, 1, 6)
    assert G.total_pages(df, 5).collect()[0].total_pages == 3


def test_pages_partition_the_table(spark):
    df = series(spark, 23, "A").unionByName(series(spark, 9, "B"))
    seen = []
    for n in range(8):
        seen += [(r.symbol, r.Date) for r in G.page(df, n, 5).collect()]
    assert sorted(seen) == sorted((r.symbol, r.Date) for r in df.collect())
    assert len(seen) == len(set(seen)) == 32


def test_top_k_latest(spark):
    df = series(spark, 10, "A").unionByName(series(spark, 10, "B"))
    rows = G.top_k_latest(df, 3).collect()
    assert [(r.Date.day, r.symbol) for r in rows] == [(9, "A"), (10, "A"), (10, "B")]


def test_date_range_inclusive(spark):
    df = series(spark, 10)
    got = G.date_range(df, "2020-01-03", "2020-01-05").count()
    assert got == 3


def test_union_with_missing_column(spark, tmp_dir):
    a = series(spark, 3, "A")
    b = series(spark, 2, "B").drop("Adj Close")
    a.write.option("header", "true").csv(f"{tmp_dir}/a")
    b.write.option("header", "true").csv(f"{tmp_dir}/b")
    u = B.coerce_defaults(CSV.read_csv_union(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"]), BAR)
    rows = u.collect()
    assert len(rows) == 5
    assert all((r["Adj Close"] is None) == (r.symbol == "B") for r in rows)


def test_lenient_union_reports_missing(spark, tmp_dir):
    series(spark, 2).write.option("header", "true").csv(f"{tmp_dir}/a")
    df, missing = CSV.read_csv_union(spark, [f"{tmp_dir}/a", f"{tmp_dir}/nope"], lenient=True)
    assert df.count() == 2 and missing == [f"{tmp_dir}/nope"]


def test_corrupt_csv_line_is_kept(spark, tmp_dir):
    import os
    os.makedirs(tmp_dir, exist_ok=True)
    with open(f"{tmp_dir}/bars.csv", "w") as f:
        f.write("Date,Open,High,Low,Close,Adj Close,Volume\n"
                "2020-01-02,1.0,2.0,0.5,1.5,1.5,100\n"
                "2020-01-03,1.5,2.5,1.0,2.0,2.0,lots\n")
    raw = CSV.read_csv(spark, f"{tmp_dir}/bars.csv", BAR_CSV)
    g0, b0 = CSV.split_corrupt(raw)                  # counted straight off the scan
    assert (g0.count(), b0.count()) == (1, 1)
    df = raw.cache()
    good, bad = CSV.split_corrupt(df)
    assert good.count() == 1
    b = bad.collect()[0]
    assert b.Volume is None and b._corrupt_record.endswith("lots")
    assert CSV.corrupt_counts(df).collect()[0].asDict() == {"good_rows": 1, "bad_rows": 1}


def test_quoted_field_with_doubled_quote(spark, tmp_dir):
    import os
    os.makedirs(tmp_dir, exist_ok=True)
    with open(f"{tmp_dir}/q.csv", "w") as f:
        f.write('name,v\n"say ""hi"", then",1\n')
    r = CSV.read_csv(spark, f"{tmp_dir}/q.csv").collect()[0]
    assert r.name == 'say "hi", then' and r.v == "1"


def test_absent_and_null_fields_default_only_on_request(spark):
    df = spark.createDataFrame([("A", None), ("B", "12")], "symbol string, Open string")
    plain = {r.symbol: r for r in B.coerce_defaults(df, BAR).collect()}
    assert plain["A"].Open is None and plain["A"].Volume is None and plain["B"].Open == 12.0
    zero = {r.symbol: r for r in B.coerce_defaults(df, BAR, default=0).collect()}
    assert zero["A"].Open == 0.0 and zero["A"].Volume == 0


def test_null_normalise(spark):
    df = spark.createDataFrame([(float("nan"), "NULL"), (1.0, "x")], "v double, s string")
    rows = B.null_normalise(df).collect()
    assert rows[0].v is None and rows[0].s is None and rows[1].v == 1.0 and rows[1].s == "x"


def test_upsert_last_version_once(spark):
    base = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "k string, v int, x double")
    delta = spark.createDataFrame([("A", 2, 5.0), ("A", 3, 6.0), ("C", 1, 7.0)],
                                  "k string, v int, x double")
    once = U.upsert(base, delta, ["k"], ["v"])
    twice = U.upsert(once, delta, ["k"], ["v"])
    want = [("A", 3, 6.0), ("B", 1, 2.0), ("C", 1, 7.0)]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, twice.collect())) == want


def test_changelog_replay_is_idempotent(spark, tmp_dir):
    log = U.ChangeLog(f"{tmp_dir}/t", ["k"])
    b0 = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "k string, x double")
    b1 = spark.createDataFrame([("A", 9.0)], "k string, x double")
    log.write_batch(b0, 0)
    log.write_batch(b1, 1)
    log.write_batch(b1, 1)  # replayed batch
    assert sorted(map(tuple, log.read(spark).collect())) == [("A", 9.0), ("B", 2.0)]


def test_retention_boundary(spark):
    now = dt.datetime(2024, 1, 10, 12, 0, 0)
    df = spark.createDataFrame(
        [(1, now - dt.timedelta(days=2), "error"),
         (2, now - dt.timedelta(days=2, seconds=1), "error"),
         (3, now - dt.timedelta(days=5), "view"),
         (4, now, "error"),
         (5, dt.datetime(2024, 1, 7, 23, 59, 59), "error"),
         (6, dt.datetime(2024, 1, 8), "error"), (7, None, "error")],
        "event_id long, ts timestamp_ntz, event_type string")
    kept = sorted(r.event_id for r in L.retention(df, "error-", 2).collect())
    assert kept == [1, 2, 3, 4, 6, 7]  # a daily set stays or goes whole


def test_word_count(spark):
    df = spark.createDataFrame([("a b  a\tc\n",), (" b",)], "text string")
    got = {r.word: r.n for r in L.word_count(df).collect()}
    assert got == {"a": 2, "b": 2, "c": 1}


def test_uptime_gaps_across_segments(spark):
    base = dt.datetime(2024, 1, 1)
    offs = [0, 10, 20, 5000, 5010, 90000, 90005]
    df = spark.createDataFrame([(i, base + dt.timedelta(seconds=s), "m")
                                for i, s in enumerate(offs)],
                               "event_id long, ts timestamp_ntz, event_type string")
    for seg_rows in (1, 2, 100):
        got = sorted((r.gap_seconds, r.gap_end)
                     for r in L.uptime_gaps(df, 3600, seg_rows=seg_rows).collect())
        assert got == [(4980.0, base + dt.timedelta(seconds=5000)),
                       (84990.0, base + dt.timedelta(seconds=90000))]


def test_availability(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(seconds=s), "m") for s in [0, 1, 5, 7, 3599]],
                               "ts timestamp_ntz, event_type string")
    r = L.availability(df, 5, "hour").collect()[0]
    assert (r.seen_slots, r.expected_slots) == (3, 720)


def test_open_gap_lasts_to_as_of(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, base, "m"), (2, base + dt.timedelta(hours=3), "n")],
                               "event_id long, ts timestamp_ntz, event_type string")
    assert [(g.monitor, g.gap_seconds) for g in L.uptime_gaps(df).collect()] == [("m", 10800.0)]
    later = L.uptime_gaps(df, as_of=base + dt.timedelta(hours=5)).collect()
    assert sorted((g.monitor, g.gap_seconds) for g in later) == [("m", 18000.0), ("n", 7200.0)]


def test_rows_of_a_key_need_a_version(spark):
    import pytest

    df = spark.createDataFrame([("A", 1.0)], "k string, x double")
    with pytest.raises(ValueError):
        U.upsert(df, df, ["k"])


def test_uncommitted_change_sets_are_not_read(spark, tmp_dir):
    import os

    log = U.ChangeLog(f"{tmp_dir}/t", ["k"])
    mk = lambda x: spark.createDataFrame([("A", x)], "k string, x double")
    log.write_batch(mk(1.0), 0)
    log.write_batch(mk(9.0), 1)
    os.remove(f"{tmp_dir}/t/changes/_batch=1/_SUCCESS")
    assert log.read(spark).first().x == 1.0


def test_last_value_of_tied_times_follows_the_id(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(2, t, "m", 5.0), (1, t, "m", 9.0)],
                               "event_id long, ts timestamp_ntz, event_type string, value double")
    assert L.metric_window(df).first().last_value == 5.0


def test_nan_counts_as_missing_in_means(spark):
    from candlestack.operators import periods as P

    day = dt.date(2024, 1, 2)
    df = spark.createDataFrame(
        [("A", day, 1.0, 1.0, 1.0, 2.0, 1), ("A", day, 1.0, 1.0, 1.0, float("nan"), 1)],
        "symbol string, Date date, Open double, High double, Low double, Close double, Volume long")
    for digits in (None, 4):
        assert P.monthly_stats(df, digits).first().Avg_Close == 2.0


def test_bars_with_sequence_number(spark):
    ticks = spark.createDataFrame(
        [("A", dt.datetime(2020, 1, 1), 3, 1.0, 30.0), ("A", dt.datetime(2020, 1, 1), 1, 1.0, 10.0),
         ("A", dt.datetime(2020, 1, 1), 2, 1.0, 20.0)],
        "sym string, t timestamp_ntz, trade_id long, q double, px double")
    r = B.bars_from_ticks(ticks, "sym", "t", "px", "q", seq="trade_id").collect()[0]
    assert (r.Open, r.Close, r.High, r.Low, r.Volume) == (10.0, 30.0, 30.0, 10.0, 3)


@pytest.mark.parametrize("bits", [(8, 8, 8), (40, 6, 62), (0, 63 - 21, 21), (62, 62, 2)])
def test_packed_order_compares_like_the_tuple(spark, bits):
    import random

    rng = random.Random(5)
    pool = [0, 1, 7, 255, 256, 2**31, 10**10 + 3, 2**62 - 1, -1, -2**40]
    rows = [tuple(rng.choice(pool) for _ in range(3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    key, rest = B.packed_order([F.col("a"), F.col("b"), F.col("c")], bits)
    kept = df.select("*", key.alias("key"), rest.alias("rest"))
    order = B.unpacked_order(F.col("key"), F.col("rest"), bits)
    assert [tuple(r)[:3] for r in kept.orderBy(order).collect()] == sorted(rows)


def test_bars_of_keys_beyond_the_packed_bits(spark):
    # part and supplier keys over 10^10, far over the bits, below zero: open and
    # close are those of the struct order
    day = dt.datetime(2024, 1, 2)
    rows = [("A", day, o, 1, p, s, 1.0, float(i)) for i, (o, p, s) in enumerate(
        [(5, 10**10 + 7, 1), (5, 10**10, 2**45), (5, 10**10, 2**45 + 1), (2**50, 1, 1),
         (2**50, 2**41, 0), (5, -3, 0), (5, -3, -9)])]
    ddl = ("l_returnflag string, l_shipdate timestamp_ntz, l_orderkey long, l_linenumber int, "
           "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double")
    df = spark.createDataFrame(rows, ddl).repartition(3)
    packed = B.bars_from_ticks(df, tiebreak=B.LINEITEM_TIEBREAK[:-1], bits=B.LINEITEM_BITS)
    got, want = packed.collect(), B.bars_from_ticks(df).collect()
    assert got == want and (got[0].Open, got[0].Close) == (6.0, 4.0)


def test_packed_order_refuses_bits_that_do_not_fit(spark):
    with pytest.raises(ValueError):
        B.packed_order([F.lit(1), F.lit(2), F.lit(3)], (62, 62, 3))
    with pytest.raises(ValueError):
        B.packed_order([F.lit(1)], (8, 8))


def test_changelog_compaction(spark, tmp_dir):
    log = U.ChangeLog(f"{tmp_dir}/t", ["k"])
    mk = lambda rows: spark.createDataFrame(rows, "k string, x double")
    log.write_batch(mk([("A", 1.0), ("B", 2.0)]), 0)
    log.write_batch(mk([("A", 3.0)]), 1)
    assert log.compact(spark) == 1
    log.write_batch(mk([("B", 5.0), ("C", 6.0)]), 2)
    assert sorted(map(tuple, log.read(spark).collect())) == [("A", 3.0), ("B", 5.0), ("C", 6.0)]


def test_null_keys_are_keys(spark):
    from candlestack.operators.quantiles import exact_quantiles

    base = spark.createDataFrame([(None, 1.0), ("A", 2.0)], "k string, x double")
    delta = spark.createDataFrame([(None, 9.0)], "k string, x double")
    got = sorted(map(tuple, U.upsert(base, delta, ["k"], delta_unique=True).collect()), key=str)
    assert got == [("A", 2.0), (None, 9.0)]
    q = {(r.k, r.p): r.quantile for r in exact_quantiles(base, ["k"], "x", [0.5]).collect()}
    assert q == {(None, 0.5): 1.0, ("A", 0.5): 2.0}


def test_epoch_millis_text(spark):
    from candlestack.functions import epoch_millis_text
    r = spark.createDataFrame([(1_700_000_000_123,)], "ms long").select(
        epoch_millis_text("ms").alias("t")).collect()[0]
    assert r.t == "2023-11-14 22:13:20"


def test_wall_clock_arithmetic_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = [(1, dt.datetime(2024, 3, 10, 1, 30), "m"), (2, dt.datetime(2024, 3, 10, 3, 30), "m"),
                (3, dt.datetime(2024, 3, 10, 2, 15, 7), "n")]   # 02:15 does not exist in LA
        df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string")
        gaps = L.uptime_gaps(df, 3600).collect()
        assert sorted((g.monitor, g.gap_seconds) for g in gaps) == [("m", 7200.0), ("n", 4493.0)]
        av = {(r.monitor, r.bucket_start.hour): r.seen_slots
              for r in L.availability(df, 5, "hour").collect()}
        assert av == {("m", 1): 1, ("m", 2): 0, ("m", 3): 1,
                      ("n", 1): 0, ("n", 2): 1, ("n", 3): 0}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_union_with_inference(spark, tmp_dir):
    series(spark, 2, "A").write.option("header", "true").csv(f"{tmp_dir}/a")
    series(spark, 2, "B").drop("Volume").write.option("header", "true").csv(f"{tmp_dir}/b")
    u = CSV.read_csv_union(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"], infer=True)
    types = dict(u.dtypes)
    assert types["Open"] == "double" and types["Volume"] in ("int", "bigint")
    assert u.where("Volume IS NULL").count() == 2
