"""Landing tables (W35): write a DataFrame as a partitioned table.

Bars land as Parquet partitioned by ``year`` so date-range reads (W6) and
retention (R5) prune folders; CSV landing keeps a header and the reader
defaults of ``sources.csv``.  Writes go through Spark's committer (task
retries are safe); a re-run with ``overwrite`` replaces the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_year(df: DataFrame, date_col: str = "Date") -> DataFrame:
    return df if "year" in df.columns else df.withColumn("year", F.year(date_col))


def land(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",),
         fmt: str = "parquet", mode: str = "overwrite",
         options: dict | None = None) -> str:
    """Write ``df`` as a table.  Rows are rebalanced by the ``partition_by`` columns:
    tasks get about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each, so small
    folders share a task and write one file, and a folder that holds a third of the rows
    is split over as many tasks as its size needs.  (Without AQE it is a plain hash
    exchange.)"""
    out = with_year(df) if "year" in partition_by else df
    if partition_by:
        out = out.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    writer = out.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


# Text formats keep full microsecond precision (the writers' defaults stop
# at milliseconds).
TEXT_TIME_OPTIONS = {"dateFormat": "yyyy-MM-dd",
                     "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                     "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def land_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (),
             mode: str = "overwrite") -> str:
    return land(df, path, partition_by, fmt="csv", mode=mode,
                options={"header": "true", "quote": '"', "escape": '"',
                         **TEXT_TIME_OPTIONS})


def land_json(df: DataFrame, path: str, partition_by: Sequence[str] = (),
              mode: str = "overwrite") -> str:
    """JSON lines (one record per line), e.g. log files for a file stream."""
    return land(df, path, partition_by, fmt="json", mode=mode, options=TEXT_TIME_OPTIONS)
