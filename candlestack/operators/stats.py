"""Descriptive statistics over bars.

W19 (price movement), W21 (summary, approximate quartiles as Spark's
``summary``), W22 (describe with exact interpolated quartiles, as pandas),
W38 (headline scalars), W39 (row count).

All are single-pass grouped aggregates per symbol (partial then final),
reshaped to long form only after aggregation, when each group is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestack.functions.numeric import avg_rounded, finite, safe_div
from candlestack.operators.quantiles import exact_quantiles

OHLCV = ("Open", "High", "Low", "Close", "Volume")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def price_movement(bars: DataFrame) -> DataFrame:
    """Intraday % move rounded to 2 digits; its mean, min and max per symbol."""
    move = F.round(safe_div(F.col("Close") - F.col("Open"), F.col("Open")) * 100, 2)
    return (bars.withColumn("Daily_Return", move)
            .groupBy("symbol")
            .agg(avg_rounded(F.col("Daily_Return"), 2).alias("Avg_Daily_Return_%"),
                 F.min("Daily_Return").alias("Max_Daily_Loss_%"),
                 F.max("Daily_Return").alias("Max_Daily_Gain_%")))


def _long_form(wide: DataFrame, keys: Sequence[str], stats: Sequence[str],
               columns: Sequence[str]) -> DataFrame:
    """One row per (keys, statistic) with one value column per input column."""
    rows = F.array(*[
        F.struct(F.lit(s).alias("statistic"),
                 *[F.col(f"{s}__{c}").alias(c) for c in columns])
        for s in stats])
    return wide.select(*keys, F.inline(rows))


def _mean(x: Column, digits: int | None) -> Column:
    return F.avg(finite(x)) if digits is None else avg_rounded(x, digits)


def _describe(bars: DataFrame, columns: Sequence[str], quartiles, names,
              digits: int | None = None) -> DataFrame:
    aggs = []
    for c in columns:
        x = _q(c).cast("double")
        qs = quartiles(x)
        aggs += [F.count(x).cast("double").alias(f"count__{c}"),
                 _mean(x, digits).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"{names[2]}__{c}"),
                 F.min(x).alias(f"min__{c}"),
                 qs[0].alias(f"25%__{c}"), qs[1].alias(f"50%__{c}"),
                 qs[2].alias(f"75%__{c}"),
                 F.max(x).alias(f"max__{c}")]
    wide = bars.groupBy("symbol").agg(*aggs)
    return _long_form(wide, ["symbol"], names, columns)


def summary_stats(bars: DataFrame, columns: Sequence[str] = OHLCV,
                  digits: int | None = None) -> DataFrame:
    """Typed twin of ``DataFrame.summary()`` per symbol: count, mean, stddev,
    min, approximate 25/50/75% (``percentile_approx``, bounded sketch), max.
    With ``digits`` the mean is exact and rounded half-up."""
    def quart(x):
        q = F.percentile_approx(x, [0.25, 0.5, 0.75], 10000)
        return [q[0], q[1], q[2]]
    names = ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
    return _describe(bars, columns, quart, names, digits)


def describe_exact(bars: DataFrame, columns: Sequence[str] = OHLCV,
                   digits: int | None = None, bounded: bool = False) -> DataFrame:
    """pandas ``describe()`` per symbol with exact, linearly interpolated
    quartiles.  Quartiles come from ``quantiles.exact_quantiles`` (sorted
    distinct values over balanced range partitions), so no task gathers a
    whole symbol; the other statistics are partial/final aggregates.  With
    ``digits`` the mean is exact and rounded half-up.  For bars keyed by
    symbol and date (``bounded``) everything is one aggregate with Spark's
    exact ``percentile``: its per-group value map is bounded by the calendar."""
    if bounded:
        def quart(x):
            q = F.percentile(x, [0.25, 0.5, 0.75])
            return [q[0], q[1], q[2]]
        names = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
        return _describe(bars, columns, quart, names, digits)
    long = bars.select("symbol", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), _q(c).cast("double").alias("value"))
        for c in columns])))
    basic = long.groupBy("symbol", "column").agg(
        F.count("value").cast("double").alias("count"),
        _mean(F.col("value"), digits).alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    quartiles = ((0.25, "25%"), (0.5, "50%"), (0.75, "75%"))
    qs = (exact_quantiles(long, ["symbol", "column"], "value", [p for p, _ in quartiles])
          .groupBy("symbol", "column")
          .agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
                 for p, name in quartiles]))
    names = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    same = basic["symbol"].eqNullSafe(qs["symbol"]) & (basic["column"] == qs["column"])
    cells = (basic.join(qs, same, "left").drop(qs["symbol"], qs["column"])
             .select("symbol", "column", F.inline(F.array(*[
                 F.struct(F.lit(n).alias("statistic"), F.col(f"`{n}`").alias("v"))
                 for n in names]))))
    return (cells.groupBy("symbol", "statistic").pivot("column", list(columns))
            .agg(F.first("v")))


def headline_stats(rolled: DataFrame) -> DataFrame:
    """Mean daily return, mean volatility, max / min close per symbol (NULLs
    skipped, as pandas skips NaN)."""
    return (rolled.groupBy("symbol")
            .agg(F.avg(_q("Daily Return")).alias("Average_Daily_Return"),
                 F.avg(_q("Volatility")).alias("Volatility"),
                 F.max("Close").alias("Max_Close"),
                 F.min("Close").alias("Min_Close")))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
