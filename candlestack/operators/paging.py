"""Ordering, ranges, top-k and paging.

W6 (inclusive date range), W23 (top-k newest), W28 (page n of size k, total
pages), W20 (statistics of every page at once).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestack.functions.numeric import avg_rounded
from candlestack.operators.series import position_index


def date_range(bars: DataFrame, start, end, col: str = "Date") -> DataFrame:
    """Rows with ``start <= col <= end``.  On a Parquet scan the bounds are
    pushed filters; on a table landed by ``year`` the matching year range is
    added so whole ``year=`` folders are pruned before any file is opened."""
    c = F.col(col)
    lo, hi = str(start), str(end)
    out = bars.where((c >= F.lit(lo).cast("date")) & (c <= F.lit(hi).cast("date")))
    if "year" in bars.columns:
        out = out.where(F.col("year").between(int(lo[:4]), int(hi[:4])))
    return out


def top_k_latest(bars: DataFrame, k: int) -> DataFrame:
    """The ``k`` newest bars (Date desc, symbol asc): a top-k sort that keeps
    at most ``k`` rows per task, then ascending for display."""
    newest = bars.orderBy(F.col("Date").desc(), F.col("symbol").asc()).limit(k)
    return newest.orderBy("Date", "symbol")


def _bar_positions(bars: DataFrame, keys: Sequence[str],
                   bounded: bool = False) -> DataFrame:
    return position_index(bars, keys, ["symbol", "Date"] if not keys else ["Date"],
                          bounded=bounded)


def page(bars: DataFrame, n: int, k: int,
         order: Sequence[str] = ("symbol", "Date")) -> DataFrame:
    """Page ``n`` (0-based) of ``k`` rows in the given total order.

    Skips, then takes (the reverse of limit-then-offset, which empties every
    page after the first).  Rows are found by their distributed position,
    whatever the depth, so no task holds ``n*k`` rows.
    """
    pos = position_index(bars, [], list(order))
    return (pos.where(F.col("_pos").between(n * k, n * k + k - 1))
            .orderBy("_pos").drop("_pos"))


def total_pages(df: DataFrame, k: int) -> DataFrame:
    return df.agg(F.ceil(F.count(F.lit(1)) / F.lit(k)).cast("long").alias("total_pages"))


def page_stats(bars: DataFrame, k: int = 5, bounded: bool = False) -> DataFrame:
    """Statistics of every page of ``k`` bars of each symbol in one job:
    first/last date, mean close (2 digits), total volume, rows.  For bars
    keyed by symbol and date (``bounded``) positions come from a per-symbol
    ``row_number``; otherwise from the global sort."""
    pos = _bar_positions(bars, ["symbol"], bounded)
    return (pos.withColumn("page", F.floor(F.col("_pos") / F.lit(k)))
            .groupBy("symbol", "page")
            .agg(F.min("Date").alias("Start_Date"), F.max("Date").alias("End_Date"),
                 avg_rounded(F.col("Close"), 2).alias("Avg_Close"),
                 F.sum("Volume").alias("Total_Volume"),
                 F.count(F.lit(1)).alias("Rows")))
