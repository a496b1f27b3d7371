"""Properties from the test strategy, on real driver data and random series."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlestack.operators import bars as B
from candlestack.operators import paging as G
from candlestack.operators import periods as P
from candlestack.operators.series import series_columns
from candlestack.sinks import upsert as U
from candlestack.sources.tables import read_table
from conftest import SF_SMOKE


def _bars(spark):
    return B.bars_from_ticks(read_table(spark, SF_SMOKE, "lineitem"))


def test_bar_invariants(spark):
    bad = _bars(spark).where("Low > Open OR Low > Close OR High < Open OR High < Close "
                             "OR Low > High").count()
    assert bad == 0


def test_levels_sum_to_the_same_totals(spark):
    long = P.period_stats_long(_bars(spark))
    tot = {r.period_type: (r.d, r.v) for r in long.groupBy("period_type").agg(
        F.sum("Trading_Days").alias("d"), F.sum("Total_Volume").alias("v")).collect()}
    assert len(set(tot.values())) == 1
    bars = _bars(spark)
    assert tot["yearly"] == (bars.count(), bars.agg(F.sum("Volume")).collect()[0][0])


def test_page_stats_cover_every_bar_once(spark):
    bars = _bars(spark)
    st_ = G.page_stats(bars, 7)
    assert st_.agg(F.sum("Rows")).collect()[0][0] == bars.count()
    assert st_.where("Rows > 7").count() == 0


def test_union_is_order_insensitive_and_upsert_idempotent(spark):
    li = read_table(spark, SF_SMOKE, "lineitem")
    a = B.bars_from_ticks(li.where("l_linestatus = 'F'"))
    b = B.bars_from_ticks(li.where("l_linestatus = 'O'"))
    keys = ["symbol", "Date"]
    ab = sorted(map(tuple, a.unionByName(b).collect()))
    ba = sorted(map(tuple, b.unionByName(a).collect()))
    assert ab == ba
    once = U.upsert(a, b, keys, delta_unique=True)
    twice = U.upsert(once, b, keys, delta_unique=True)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == once.select(*keys).distinct().count()


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(lengths=st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=3),
       seg_rows=st.integers(min_value=1, max_value=25),
       halo=st.integers(min_value=1, max_value=6))
def test_segmented_lag_sum_equals_plain_window(spark, lengths, seg_rows, halo):
    rows = [(f"s{i}", dt.date(2020, 1, 1) + dt.timedelta(days=d), float(d * (i + 1)))
            for i, n in enumerate(lengths) for d in range(n)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "symbol string, Date date, x double")
    frame = lambda w: w.rowsBetween(-halo, 0)
    got = series_columns(df, ["symbol"], ["Date"], halo,
                         lambda w: [{"s": F.sum("x").over(frame(w)),
                                     "p": F.lag("x", halo).over(w)}], seg_rows=seg_rows)
    w = Window.partitionBy("symbol").orderBy("Date")
    want = df.withColumns({"s": F.sum("x").over(frame(w)), "p": F.lag("x", halo).over(w)})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_deep_and_shallow_pages_agree_on_driver_data(spark):
    bars = _bars(spark)
    for n in (0, 7, 100, 1497):
        a = [tuple(r) for r in G.page(bars, n, 5).collect()]
        b = [tuple(r) for r in G.page(bars, n, 5).collect()]
        assert a == b


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=st.lists(st.integers(min_value=0, max_value=900), min_size=1, max_size=40,
                     unique=True),
       closes=st.lists(st.integers(min_value=1, max_value=10_000), min_size=40, max_size=40))
def test_random_bars_level_totals(spark, days, closes):
    rows = [("S", dt.date(2019, 1, 1) + dt.timedelta(days=d), 1.0, 2.0, 0.5,
             closes[i] / 100, closes[i] / 100, i + 1) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "symbol string, Date date, Open double, High double, "
                                     "Low double, Close double, `Adj Close` double, Volume long")
    long = P.period_stats_long(df)
    tot = {r.period_type: (r.d, r.v) for r in long.groupBy("period_type").agg(
        F.sum("Trading_Days").alias("d"), F.sum("Total_Volume").alias("v")).collect()}
    want = (len(days), sum(range(1, len(days) + 1)))
    assert tot == {"monthly": want, "quarterly": want, "yearly": want}


def test_packed_tick_order_is_exact_on_every_driver_scale(spark):
    from candlestack.plans.queries import LINEITEM_ORDER

    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        li = read_table(spark, sf, "lineitem")
        dups = B.duplicate_tick_keys(li, LINEITEM_ORDER, "l_returnflag", "l_shipdate")
        assert dups.count() == 0, sf


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(offsets=st.lists(st.tuples(st.sampled_from(["m", "n"]),
                                  st.integers(min_value=0, max_value=40_000)),
                        min_size=2, max_size=40, unique_by=lambda t: t[1]),
       seg_rows=st.integers(min_value=1, max_value=7))
def test_uptime_gaps_match_brute_force(spark, offsets, seg_rows):
    from candlestack.operators import logs as L

    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=s), k) for i, (k, s) in enumerate(offsets)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string")
    want = []
    for k in ("m", "n"):
        ts = sorted(s for kk, s in offsets if kk == k)
        ts += [max(s for _, s in offsets)] if ts else []  # silent to the end
        want += [(k, float(b - a)) for a, b in zip(ts, ts[1:]) if b - a > 3600]
    got = [(r.monitor, r.gap_seconds)
           for r in L.uptime_gaps(df, 3600, seg_rows=seg_rows).collect()]
    assert sorted(got) == sorted(want)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=st.lists(st.tuples(st.sampled_from(["a", "b"]),
                                 st.integers(min_value=0, max_value=120),
                                 st.integers(min_value=0, max_value=99)),
                       min_size=1, max_size=40, unique_by=lambda t: t[1]))
def test_metric_window_matches_brute_force(spark, events):
    from candlestack.operators import logs as L

    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=s), k, float(v)) for k, s, v in events]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double")
    got = {(r.window_start, r.event_type): (r.n, r.max_value, r.last_value)
           for r in L.metric_window(df, "10 seconds").collect()}
    want = {}
    for k, s, v in sorted(events, key=lambda e: e[1]):
        key = (base + dt.timedelta(seconds=s - s % 10), k)
        n, mx, _ = want.get(key, (0, float("-inf"), None))
        want[key] = (n + 1, max(mx, float(v)), float(v))
    assert got == want


def test_word_count_matches_python_on_driver_texts(spark):
    import re
    from collections import Counter

    from candlestack.operators import logs as L

    docs = read_table(spark, SF_SMOKE, "documents")
    want = Counter(w for (t,) in docs.select("text").collect() if t is not None
                   for w in re.split(r"[ \t\n\r\f]+", t) if w)
    got = {r.word: r.n for r in L.word_count(docs).collect()}
    assert got == dict(want)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(secs=st.lists(st.integers(min_value=0, max_value=7200), min_size=1, max_size=50))
def test_availability_matches_brute_force(spark, secs):
    from candlestack.operators import logs as L

    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(seconds=s), "m") for s in secs],
                               "ts timestamp_ntz, event_type string")
    got = {r.bucket_start.hour: r.seen_slots for r in L.availability(df, 5, "hour").collect()}
    want = {}
    hours = {s // 3600 for s in secs}
    for h in range(min(hours), max(hours) + 1):
        want[h] = len({(s % 3600) // 5 for s in secs if s // 3600 == h})
    assert got == want


def test_pandas_twins_on_driver_bars(spark):
    import pandas as pd
    import pytest

    from candlestack.operators import rolling as R

    bars = _bars(spark)
    pdf = bars.toPandas()
    pdf["Month"] = pd.to_datetime(pdf["Date"]).dt.strftime("%Y-%m")
    want = pdf.groupby(["symbol", "Month"]).agg(
        Avg_Close=("Close", "mean"), Std_Close=("Close", "std"),
        Trading_Days=("Close", "size"), Total_Volume=("Volume", "sum"))
    got = P.monthly_stats(bars).toPandas().set_index(["symbol", "Month"]).sort_index()
    want = want.sort_index()
    assert list(got.index) == list(want.index)
    for c in ["Avg_Close", "Std_Close"]:
        assert got[c].to_numpy() == pytest.approx(want[c].to_numpy(), nan_ok=True)
    assert (got["Trading_Days"].to_numpy() == want["Trading_Days"].to_numpy()).all()
    assert (got["Total_Volume"].to_numpy() == want["Total_Volume"].to_numpy()).all()

    rolled = R.rolling_analytics(bars, bounded=True).toPandas()
    for sym, g in pdf.sort_values("Date").groupby("symbol"):
        ret = g["Close"].pct_change()
        vol = (ret.rolling(20).std() * 252 ** 0.5).to_numpy()
        mine = rolled[rolled.symbol == sym].sort_values("Date")["Volatility"].to_numpy()
        assert mine == pytest.approx(vol, nan_ok=True)


def test_describe_matches_pandas_on_driver_bars(spark):
    import pytest

    from candlestack.operators import stats as S

    bars = _bars(spark)
    pdf = bars.toPandas()
    for bound in (False, True):
        got = {(r.symbol, r.statistic): r for r in S.describe_exact(bars, bounded=bound).collect()}
        for sym, g in pdf.groupby("symbol"):
            d = g[["Open", "High", "Low", "Close", "Volume"]].astype(float).describe()
            for stat in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
                row = got[(sym, stat)]
                for c in ["Open", "High", "Low", "Close", "Volume"]:
                    assert row[c] == pytest.approx(d.loc[stat, c]), (bound, sym, stat, c)


def test_page_stats_paths_agree_on_driver_bars(spark):
    bars = _bars(spark)
    a = sorted(map(tuple, G.page_stats(bars, 7).collect()))
    b = sorted(map(tuple, G.page_stats(bars, 7, bounded=True).collect()))
    assert a == b
