"""Quartiles that merge (W21): stored KLL sketches of bar columns.

``month_sketches`` holds one sketch per symbol, month and column;
``merge_sketches`` combines sketches of one month that come from several
batches, ``period_quartiles`` merges months to quarters and years.  History is
never read again: a quartile of any period comes from a few small binary
values.  A sketch of at most ``k`` values holds them all, so its quartiles are
exact (the least value whose share of values up to it reaches the quantile);
beyond that the error in rank shrinks in proportion to ``k``.  Only built-in
functions, all partial before the shuffle, so a hot symbol is combined
map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestack.functions.numeric import finite
from candlestack.operators.periods import period_type_of_set, with_period_labels

#: A year of daily bars fits, so its quartiles are exact; 8 KB a sketch when full.
SKETCH_K = 1024
SKETCHED = ("Open", "High", "Low", "Close", "Volume")
QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
MONTH_KEYS = ["symbol", "month"]


def _merged(columns: Sequence[str], k: int) -> list[Column]:
    return [F.kll_merge_agg_double(f"`{c}`", F.lit(k)).alias(c) for c in columns]


def month_sketches(bars: DataFrame, columns: Sequence[str] = SKETCHED,
                   k: int = SKETCH_K) -> DataFrame:
    """(symbol, month, a sketch per column) of ``bars``; nulls, NaN and infinities
    count as missing, as they do in the other period statistics."""
    return (bars.withColumn("month", F.trunc("Date", "month"))
            .groupBy(*MONTH_KEYS)
            .agg(*[F.kll_sketch_agg_double(finite(F.col(f"`{c}`").cast("double")), F.lit(k))
                   .alias(c) for c in columns]))


def merge_sketches(sketches: DataFrame, columns: Sequence[str] = SKETCHED,
                   k: int = SKETCH_K) -> DataFrame:
    """One row per symbol and month from partial sketches of it."""
    return sketches.groupBy(*MONTH_KEYS).agg(*_merged(columns, k))


def period_quartiles(sketches: DataFrame, columns: Sequence[str] = SKETCHED,
                     k: int = SKETCH_K) -> DataFrame:
    """(symbol, period_type, period, column, n, 25%, 50%, 75%) of months, quarters and
    years from the sketches of months, in one pass.  Without a value ``n`` is 0 and
    the quartiles are null."""
    labelled = with_period_labels(sketches.withColumnRenamed("month", "Date"))
    merged = (labelled.groupingSets([["symbol", "Year"], ["symbol", "Quarter"],
                                     ["symbol", "Month"]],
                                    "symbol", "Year", "Quarter", "Month")
              .agg(F.grouping_id().alias("_set"), *_merged(columns, k)))
    long = merged.select(
        "symbol", period_type_of_set().alias("period_type"),
        F.coalesce("Month", "Quarter", F.col("Year").cast("string")).alias("period"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("sketch"))
                           for c in columns])))
    n = F.kll_sketch_get_n_double("sketch")
    return long.select(
        "symbol", "period_type", "period", "column", n.alias("n"),
        *[F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias(name)
          for name, p in QUARTILES.items()])
