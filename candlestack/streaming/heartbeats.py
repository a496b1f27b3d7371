"""Silences of monitors as a stream (R4).

A *session* is a run of a monitor's heartbeats without a silence longer than
the threshold: a session window whose gap is the threshold.  Its state is one
row per open session (first and last beat), not the beats.  A session closes
when the watermark passes its last beat by the threshold, and is written at
that moment: the silence is reported although the monitor sends nothing.

Event time must go on for that.  Beats of other monitors move it; where all
fall silent, clock ticks do (``clock_tick``): rows of no monitor in the same
stream, written by whatever schedules the probes.

Sessions merge within each task before the shuffle, so a monitor with a third
of all beats sends one row a run and task, not its beats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlestack.functions.dates import wall_clock_micros

LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
SESSION_KEYS = ("monitor", "first_beat")


def clock_tick(source: DataFrame, at, key: str = "event_type", ts: str = "ts") -> DataFrame:
    """One row of ``source``'s columns that belongs to no monitor (a null key) and
    says that the time is ``at``."""
    spark = source.sparkSession
    kind = source.schema[ts].dataType
    return spark.range(1).select(*[
        (F.lit(str(at)).cast(kind) if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in source.schema.fields])


def beat_sessions(beats: DataFrame, threshold_seconds: float, key: str = "event_type",
                  ts: str = "ts") -> DataFrame:
    """(monitor, first_beat, last_beat, beats) of each session.  Works on a batch and,
    behind a watermark, on a stream."""
    gap = f"{int(round(threshold_seconds * 1_000_000))} microseconds"
    return (beats.where(F.col(ts).isNotNull())
            .groupBy(F.col(key).alias("monitor"), F.session_window(F.col(ts), gap).alias("w"))
            .agg(F.min(ts).alias("first_beat"), F.max(ts).alias("last_beat"),
                 F.count(F.lit(1)).alias("beats"))
            .drop("w"))


def beat_sessions_stream(source: DataFrame, path: str, checkpoint: str,
                         threshold_seconds: float = 3600.0, watermark: str = "1 hour",
                         key: str = "event_type", ts: str = "ts",
                         available_now: bool = True) -> StreamingQuery:
    """Appends every closed session to the Parquet folder ``path``.  A beat behind the
    watermark is late and dropped."""
    spark = source.sparkSession
    spark.conf.set(LOCAL_MERGE, "true")
    beats = (source.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark))
    sessions = beat_sessions(beats, threshold_seconds, key, ts)
    writer = (sessions.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def _seconds(a: Column, b: Column) -> Column:
    return (wall_clock_micros(b) - wall_clock_micros(a)) / F.lit(1_000_000.0)


def gaps_of_sessions(sessions: DataFrame, threshold_seconds: float = 3600.0, as_of=None,
                     kind: T.DataType | None = None) -> DataFrame:
    """Silences (monitor, gap_start, gap_end, gap_seconds) between the sessions of a
    monitor, and from its last one to ``as_of`` (the newest beat of any monitor).

    Sessions of a monitor lie at least the threshold apart, so their number is
    bounded by the history's length, not by its beats: a plain window."""
    # rows of no monitor are clock ticks
    own = sessions.where(F.col("monitor").isNotNull())
    if kind is not None:
        own = own.withColumns({c: F.col(c).cast(kind) for c in ("first_beat", "last_beat")})
    now = (own.select(F.max("last_beat")).scalar() if as_of is None
           else F.lit(str(as_of)).cast(own.schema["last_beat"].dataType))
    w = Window.partitionBy("monitor").orderBy("first_beat")
    nxt = F.coalesce(F.lead("first_beat").over(w), now)
    return (own.select("monitor", F.col("last_beat").alias("gap_start"), nxt.alias("gap_end"))
            .withColumn("gap_seconds", _seconds(F.col("gap_start"), F.col("gap_end")))
            .where(F.col("gap_seconds") > F.lit(float(threshold_seconds))))


def silent_now(sessions: DataFrame, as_of, threshold_seconds: float = 3600.0) -> DataFrame:
    """(monitor, gap_start, silent_seconds) of monitors whose last session closed and that
    have been silent for longer than the threshold at ``as_of``."""
    last = (sessions.where(F.col("monitor").isNotNull())
            .groupBy("monitor").agg(F.max("last_beat").alias("gap_start")))
    now = F.lit(str(as_of)).cast(sessions.schema["last_beat"].dataType)
    return (last.withColumn("silent_seconds", _seconds(F.col("gap_start"), now))
            .where(F.col("silent_seconds") > F.lit(float(threshold_seconds))))
