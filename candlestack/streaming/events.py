"""Structured Streaming forms of log ingest (R2) and metric windows (R3).

``any_log_stream`` is log ingest for payloads of which nothing is declared.

Sources are file streams (new files in a folder are new data); sinks carry a
checkpoint, so a restarted query resumes where it stopped and replays at
most one micro-batch, which the sinks absorb (file sink commit log, keyed
change log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlestack.operators.logs import metric_window, parse_events
from candlestack.operators.payloads import PAYLOAD, parse_lines
from candlestack.sinks.upsert import ChangeLog


# Text sources parse timestamps with microseconds (as landing writes them).
TEXT_TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
                     "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt in ("json", "csv"):
        reader = reader.options(**TEXT_TIME_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def single_file_glob(path: str) -> str:
    """A file stream source needs a folder or a glob; this glob matches
    exactly one file (its last character as a one-letter class)."""
    return f"{path[:-1]}[{path[-1]}]"


def log_ingest_stream(source: DataFrame, out_path: str, checkpoint: str,
                      available_now: bool = True) -> StreamingQuery:
    """Parse each log record and append it to a Parquet folder."""
    writer = (parse_events(source).writeStream.format("parquet")
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)


def metric_window_stream(source: DataFrame, table: ChangeLog, checkpoint: str,
                         period: str = "10 seconds", watermark: str = "1 hour",
                         key: str = "event_type", ts: str = "ts", value: str = "value",
                         available_now: bool = True) -> StreamingQuery:
    """Windowed samples with a watermark: rows older than the watermark are
    dropped and their windows' state is evicted.  Update mode into a keyed
    change log, so every window's final value lands even when the stream
    stops before the watermark passes the last windows."""
    ts_type = source.schema[ts].dataType
    events = (source.withColumn(ts, F.col(ts).cast("timestamp"))
              .withWatermark(ts, watermark))
    windows = metric_window(events, period, key, ts, value)
    if isinstance(ts_type, T.TimestampNTZType):
        windows = windows.withColumns({
            "window_start": F.col("window_start").cast("timestamp_ntz"),
            "window_end": F.col("window_end").cast("timestamp_ntz")})
    writer = (windows.writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(table.foreach_batch))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def any_log_stream(lines: DataFrame, path: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Log lines (value) with any JSON payload: each micro-batch appends its payloads as
    VARIANT to ``<path>/good`` and the lines that are not JSON, with their text, to
    ``<path>/bad``, in a folder of the batch that a replay overwrites."""
    def each(batch: DataFrame, batch_id: int) -> None:
        # one pass: the sides are folders of one write
        parsed = parse_lines(batch).where(F.col("value").isNotNull())
        side = F.when(F.col(PAYLOAD).isNull(), F.lit("bad")).otherwise(F.lit("good"))
        kept = F.when(F.col(PAYLOAD).isNull(), F.col("value"))
        (parsed.withColumn("value", kept).withColumn("side", side)
         .write.mode("overwrite").partitionBy("side").parquet(f"{path}/batch={int(batch_id)}"))

    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_any_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(payloads, bad lines) that ``any_log_stream`` wrote; each reads only its folders."""
    rows = spark.read.parquet(path)
    return (rows.where(F.col("side") == "good").select(PAYLOAD),
            rows.where(F.col("side") == "bad").select("value"))
