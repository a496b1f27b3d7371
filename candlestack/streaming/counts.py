"""Word counts (R1), period statistics (W16, W17), quartiles (W21) and tick bars (R6)
kept up to date from streams without growing state: each micro-batch writes its partial aggregates
(``sinks.partials.PartialLog``), a read combines them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlestack.operators.bars import BAR_COLUMNS, bar_partials, bars_of_partials, merge_bars
from candlestack.operators.logs import word_count
from candlestack.operators.periods import merge_moments, period_moments, stats_of_moments
from candlestack.operators.sketches import (MONTH_KEYS, merge_sketches, month_sketches,
                                            period_quartiles)
from candlestack.sinks.partials import PartialLog, added


def _start(source: DataFrame, each, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# --- word count -------------------------------------------------------------------

def word_log(path: str) -> PartialLog:
    return PartialLog(path, ["word"], added(["word"], ["n"]))


def word_count_stream(source: DataFrame, log: PartialLog, checkpoint: str, text: str = "text",
                      available_now: bool = True) -> StreamingQuery:
    """Counts of each micro-batch's own texts into ``log``; its read is ``word_count``
    of all texts so far."""
    def each(batch: DataFrame, batch_id: int) -> None:
        log.write_batch(word_count(batch, text), batch_id)

    return _start(source, each, checkpoint, available_now)


# --- bars of ticks ------------------------------------------------------------------

def tick_bar_log(path: str) -> PartialLog:
    return PartialLog(path, ["symbol", "Date"], merge_bars)


def tick_bar_stream(ticks: DataFrame, log: PartialLog, checkpoint: str,
                    available_now: bool = True, **columns) -> StreamingQuery:
    """Partial bars of each micro-batch's own ticks into ``log``: first and last tick
    with their places in the order, extremes and volume.  The streaming state is empty,
    whatever the number of symbols and days; ``read_tick_bars`` gives the bars."""
    def each(batch: DataFrame, batch_id: int) -> None:
        log.write_batch(bar_partials(batch, **columns), batch_id)

    return _start(ticks, each, checkpoint, available_now)


def read_tick_bars(spark: SparkSession, log: PartialLog) -> DataFrame:
    return bars_of_partials(log.read(spark)).select(*[F.col(f"`{c}`") for c in BAR_COLUMNS])


# --- period statistics ----------------------------------------------------------------

def period_log(path: str) -> PartialLog:
    return PartialLog(path, ["symbol", "period_type", "period"], merge_moments)


def period_stats_stream(bars: DataFrame, log: PartialLog, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    """Moments of each micro-batch's own bars, by month, quarter and year, into ``log``.
    Every bar arrives once (a correction is a bar of another key or a new log)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        log.write_batch(period_moments(batch), batch_id)

    return _start(bars, each, checkpoint, available_now)


def read_period_stats(spark: SparkSession, log: PartialLog, digits: int | None = None) -> DataFrame:
    """``period_stats_long`` of all bars so far, from the merged moments: no history is
    read again."""
    return stats_of_moments(log.read(spark), digits)


# --- quartiles --------------------------------------------------------------------------

def sketch_log(path: str) -> PartialLog:
    return PartialLog(path, MONTH_KEYS, merge_sketches)


def quartile_stream(bars: DataFrame, log: PartialLog, checkpoint: str,
                    available_now: bool = True) -> StreamingQuery:
    """Sketches of each micro-batch's own bars, by month, into ``log``; every bar
    arrives once, as for ``period_stats_stream``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        log.write_batch(month_sketches(batch), batch_id)

    return _start(bars, each, checkpoint, available_now)


def read_quartiles(spark: SparkSession, log: PartialLog) -> DataFrame:
    """``period_quartiles`` of all bars so far."""
    return period_quartiles(log.read(spark))
