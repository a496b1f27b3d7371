"""Daily incremental bars (R6): new bar files are merged into the keyed
bar table by (symbol, Date).

Each micro-batch is deduplicated, then written as its own change set
(``sinks.upsert.ChangeLog``); the table read is the latest row per key.  A
replayed micro-batch overwrites its own change set, so re-runs are
idempotent, and a daily increment covers the half-open day [d, d+1).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlestack.sinks.points import bar_points
from candlestack.sinks.upsert import ChangeLog, latest_per_key

BAR_KEYS = ("symbol", "Date")


def day_slice(bars: DataFrame, day, date_col: str = "Date") -> DataFrame:
    """Rows of one day, [d, d+1)."""
    d = day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))
    nxt = d + dt.timedelta(days=1)
    c = F.col(date_col)
    return bars.where((c >= F.lit(d.isoformat()).cast("date"))
                      & (c < F.lit(nxt.isoformat()).cast("date")))


def incremental_bars_stream(source: DataFrame, table: ChangeLog, checkpoint: str,
                            available_now: bool = True,
                            points_path: str | None = None,
                            point_digits: int | None = None) -> StreamingQuery:
    """Merge new bar files into ``table``.  Of several rows of a key in one
    micro-batch the one in the latest file (by modification time, then name)
    wins, as it would in a later micro-batch; with ``points_path`` each
    micro-batch's bars are also rendered as line-protocol points into
    ``<points_path>/_batch=<id>`` (overwritten on replay, so idempotent),
    rounded to ``point_digits`` digits where given."""
    cols = [c for c in source.columns if c != "year"]
    version = ["_file_time", "_file"]
    source = source.select(*cols, F.col("_metadata.file_modification_time").alias(version[0]),
                           F.col("_metadata.file_path").alias(version[1]))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = latest_per_key(batch, BAR_KEYS, version).select(*[F.col(f"`{c}`") for c in cols])
        if points_path is None:
            table.write_batch(batch, batch_id)
            return
        # two sinks read the batch: keep it for both (recomputable from the
        # source files if an executor is lost)
        batch.persist()
        try:
            table.write_batch(batch, batch_id)
            pts = bar_points(batch, digits=point_digits)  # the six fields of a bar, no derived ones
            pts.select("line").write.mode("overwrite").text(
                f"{points_path}/_batch={int(batch_id)}")
        finally:
            batch.unpersist()

    writer = (source.writeStream
              .option("checkpointLocation", checkpoint)
              .foreachBatch(each))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
