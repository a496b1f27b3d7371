"""Mergeable quartiles: exact below k values, bounded in rank beyond, any split merges alike."""
import datetime as dt
import math
import random

from pyspark.sql import functions as F

from candlestack.operators import sketches as SK

SCHEMA = "symbol string, Date date, Close double"


def rank_error(values, got, p):
    """How far the share of values up to ``got`` lies from ``p``."""
    below = sum(v < got for v in values) / len(values)
    upto = sum(v <= got for v in values) / len(values)
    return max(0.0, below - p, p - upto)


def quartiles(spark, rows, parts, k):
    batches = [spark.createDataFrame(rows[i::parts], SCHEMA) for i in range(parts)]
    stored = None
    for b in batches:
        s = SK.month_sketches(b, ["Close"], k)
        stored = s if stored is None else stored.unionAll(s)
    merged = SK.merge_sketches(stored, ["Close"], k)
    return {(r.symbol, r.period): r for r in SK.period_quartiles(merged, ["Close"], k).collect()}


def test_small_periods_are_exact_however_they_are_split(spark):
    rng = random.Random(3)
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), rng.choice([1.0, 2.5, 7.0, -3.0]))
            for i in range(366)]
    for parts in (1, 4):
        got = quartiles(spark, rows, parts, SK.SKETCH_K)
        assert len(got) == 12 + 4 + 1
        for period, rs in (("2020", rows), ("2020-Q2", rows[91:182]), ("2020-02", rows[31:60])):
            xs = sorted(r[2] for r in rs)
            row = got["A", period]
            assert row["n"] == len(xs) and row["column"] == "Close"
            for name, p in SK.QUARTILES.items():
                assert row[name] == xs[math.ceil(p * len(xs)) - 1]


def test_rank_error_is_bounded_beyond_k(spark):
    rng = random.Random(5)
    rows = [("A", dt.date(2020, 1 + i % 12, 1), rng.lognormvariate(0, 2)) for i in range(30_000)]
    for k, bound in ((64, 0.06), (512, 0.01)):
        row = quartiles(spark, rows, 5, k)["A", "2020"]
        assert row["n"] == len(rows)
        for name, p in SK.QUARTILES.items():
            assert rank_error([r[2] for r in rows], row[name], p) <= bound


def test_missing_values(spark):
    rows = [("A", dt.date(2020, 1, 1), None), ("A", dt.date(2020, 1, 2), float("nan")),
            ("A", dt.date(2020, 1, 3), float("inf")), ("A", dt.date(2020, 2, 1), 4.0),
            (None, dt.date(2020, 2, 1), 5.0)]
    got = quartiles(spark, rows, 2, SK.SKETCH_K)
    assert got["A", "2020-01"]["n"] == 0 and got["A", "2020-01"]["50%"] is None
    assert got["A", "2020"]["n"] == 1 and got["A", "2020"]["25%"] == 4.0
    assert got[None, "2020-02"]["50%"] == 5.0
    empty = spark.createDataFrame([], SCHEMA)
    assert SK.period_quartiles(SK.month_sketches(empty, ["Close"]), ["Close"]).count() == 0


def test_sketches_are_built_before_the_shuffle(spark):
    bars = spark.range(100).select(F.lit("A").alias("symbol"),
                                   F.current_date().alias("Date"), F.col("id").alias("Close"))
    plan = SK.period_quartiles(SK.month_sketches(bars, ["Close"]), ["Close"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in text and "partial_kll_merge_agg_double" in text
    assert "Python" not in text
