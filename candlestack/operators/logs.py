"""Log / metric / availability operators (batch forms).

R1 word count, R2 log ingest (parse the JSON payload), R3 fixed-period
metric samples, R4 heartbeat gaps and per-hour availability, R5 retention.
The streaming forms of R2/R3 live in ``candlestack.streaming``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlestack.functions.dates import truncate_wall_clock, wall_clock_micros
from candlestack.operators.series import DEFAULT_SEG_ROWS, series_columns

# The word-count tokenizer's delimiters are the five
# whitespace characters space, tab, newline, carriage return, form feed.
WORD_DELIMITERS = r"[ \t\n\r\f]+"

EVENT_PAYLOAD = T.StructType([T.StructField("k", T.LongType(), True)])


def word_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over every token of every text.  Tokens come from a JVM-side
    split; a hot word is combined map-side by the partial aggregate."""
    words = docs.select(F.explode(F.split(F.col(text), WORD_DELIMITERS)).alias("word"))
    return (words.where(F.col("word") != "")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def parse_events(events: DataFrame, payload: str = "props",
                 schema: T.StructType = EVENT_PAYLOAD) -> DataFrame:
    """Log ingest: keep every field, expand the JSON payload into columns."""
    parsed = F.from_json(F.col(payload), schema)
    return events.select(*[c for c in events.columns if c != payload],
                         *[parsed[f.name].alias(f.name) for f in schema.fields])


def metric_window(events: DataFrame, period: str = "10 seconds", key: str = "event_type",
                  ts: str = "ts", value: str = "value", tiebreak: str = "event_id") -> DataFrame:
    """Fixed-period samples per key: count, mean, min, max and last value.
    Of events at the same time the one with the greatest ``tiebreak`` is last
    (a table without that column must have distinct times)."""
    last = F.struct(ts, tiebreak) if tiebreak in events.columns else F.col(ts)
    return (events.groupBy(F.window(F.col(ts), period).alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(value).alias("avg_value"),
                 F.min(value).alias("min_value"),
                 F.max(value).alias("max_value"),
                 F.max_by(value, last).alias("last_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    key, "n", "avg_value", "min_value", "max_value", "last_value"))


def _seconds_between(a: Column, b: Column) -> Column:
    """Wall-clock seconds from ``a`` to ``b`` (time-zone free)."""
    return (wall_clock_micros(b) - wall_clock_micros(a)) / F.lit(1_000_000.0)


def uptime_gaps(events: DataFrame, threshold_seconds: float = 3600.0,
                key: str = "event_type", ts: str = "ts", tiebreak: str = "event_id",
                seg_rows: int = DEFAULT_SEG_ROWS, as_of=None) -> DataFrame:
    """Silences longer than ``threshold_seconds`` of a monitor, between
    consecutive heartbeats and from its last one to ``as_of`` (the newest time
    in the data): (monitor, gap_start, gap_end, gap_seconds).

    Nothing bounds the heartbeats of one monitor, so ``lag`` always runs on
    bounded segments with a one-row halo (``operators.series``).
    """
    prev = "_prev_ts"
    with_prev = series_columns(
        events.select(key, ts, tiebreak), keys=[key], order=[ts, tiebreak], halo=1,
        stages=lambda w: [{prev: F.lag(ts).over(w)}], seg_rows=seg_rows)
    gap = _seconds_between(F.col(prev), F.col(ts))
    closed = with_prev.select(F.col(key).alias("monitor"), F.col(prev).alias("gap_start"),
                              F.col(ts).alias("gap_end"), gap.alias("gap_seconds"))
    still = _seconds_between(F.col("gap_start"), F.col("gap_end"))
    open_ = (events.groupBy(F.col(key).alias("monitor")).agg(F.max(ts).alias("gap_start"))
             .withColumn("gap_end", _as_of(events, ts, as_of)).withColumn("gap_seconds", still))
    return closed.unionByName(open_).where(F.col("gap_seconds") > F.lit(float(threshold_seconds)))


def _as_of(events: DataFrame, ts: str, as_of) -> Column:
    """``as_of`` in the type of ``ts``; by default the newest time in the data
    (a scalar subquery), not the wall clock."""
    if as_of is None:
        return events.select(F.max(ts)).scalar()
    return F.lit(str(as_of)).cast(events.schema[ts].dataType)


def availability(events: DataFrame, every_seconds: int = 5, bucket: str = "hour",
                 key: str = "event_type", ts: str = "ts") -> DataFrame:
    """Per monitor and hour: distinct heartbeat slots seen vs expected, for
    every hour from the oldest to the newest in the data; hours in which a
    monitor was silent have zero slots.  Events without a time are left out.

    The silent hours follow from the next hour seen; a monitor has no more
    rows in that window than the calendar has hours."""
    # bucket and slot from the wall-clock fields (no time-zone round trip)
    b = truncate_wall_clock(F.col(ts), bucket)
    slot = F.floor((wall_clock_micros(F.col(ts)) - wall_clock_micros(b))
                   / F.lit(every_seconds * 1_000_000))
    per_bucket = {"hour": 3600, "minute": 60, "day": 86400}[bucket] // every_seconds
    step = F.expr(f"interval 1 {bucket}")
    bounds = events.select(F.min(ts).alias("lo"), F.max(ts).alias("hi")).select(
        F.struct(truncate_wall_clock(F.col("lo"), bucket).alias("lo"),
                 truncate_wall_clock(F.col("hi"), bucket).alias("hi"))).scalar()
    seen = (events.where(F.col(ts).isNotNull())
            .select(F.col(key).alias("monitor"), b.alias("at"), slot.alias("slot"))
            .groupBy("monitor", "at").agg(F.count_distinct("slot").alias("n"))
            .withColumn("range", bounds))
    w = Window.partitionBy("monitor").orderBy("at")
    hours = F.sequence(F.when(F.row_number().over(w) == 1, F.col("range.lo"))
                       .otherwise(F.col("at")),
                       F.coalesce(F.lead("at").over(w) - step, F.col("range.hi")), step)
    return (seen.withColumn("hours", hours)
            .select("monitor", "at", "n", F.explode("hours").alias("hour"))
            .select("monitor", F.col("hour").cast(events.schema[ts].dataType).alias("bucket_start"),
                    F.when(F.col("hour") == F.col("at"), F.col("n")).otherwise(F.lit(0))
                    .cast("long").alias("seen_slots"))
            .withColumn("expected_slots", F.lit(per_bucket).cast("long"))
            .withColumn("availability",
                        F.col("seen_slots") / F.col("expected_slots")))


def set_name(key: Column, ts: Column) -> Column:
    """Daily set (index) name: ``<key>-yyyy.MM.dd``."""
    return F.concat(key, F.lit("-"), F.date_format(ts, "yyyy.MM.dd"))


def retention(events: DataFrame, prefix: str, days: int = 2, as_of=None,
              key: str = "event_type", ts: str = "ts") -> DataFrame:
    """Drop daily sets whose name starts with ``prefix`` once their day is more
    than ``days`` before the day of ``as_of`` (the newest time in the data).
    A set stays or goes whole; rows without a key or time are in no set and
    stay."""
    named = events.withColumn("set_name", set_name(F.col(key), F.col(ts)))
    expired = (F.col("set_name").startswith(prefix)
               & (F.to_date(ts) < F.date_sub(F.to_date(_as_of(events, ts, as_of)), days)))
    return named.where(~F.coalesce(expired, F.lit(False)))


def expired_sets(sets: DataFrame, prefix: str, days: int, as_of, name: str = "set_name",
                 columns: tuple = ("set_name",)) -> DataFrame:
    """Set names (``<key>-yyyy.MM.dd``) with ``prefix`` whose day is more than
    ``days`` before ``as_of``: the sets a retention sweep drops whole."""
    day = F.try_to_date(F.regexp_extract(F.col(name), r"(\d{4}\.\d{2}\.\d{2})$", 1),
                        "yyyy.MM.dd")
    cutoff = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    return sets.where(F.col(name).startswith(prefix) & (day < cutoff)).select(*columns)
