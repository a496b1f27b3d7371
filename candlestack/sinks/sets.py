"""Daily sets of events and their retention (R5).

A table of events in one folder per daily set (``set_name=<key>-yyyy.MM.dd``).
Sets are known from the listing of their files alone.  A sweep drops expired
sets whole: the rule runs in Spark over the listing, and the tasks that hold
the listing delete the files, so neither names nor rows reach the driver.
Deleting is safe to repeat: a task that runs again finds files gone.

The stream writes each micro-batch into files of its own in the sets' folders,
by dynamic partition overwrite of (set_name, part): a batch that is replayed
replaces what it wrote and nothing else.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlestack.operators.logs import expired_sets, set_name
from candlestack.sources.manifest import list_files

# Shipped by value, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SET, PART = "set_name", "part"


def _delete_files(batches: Iterator) -> Iterator:
    """(set_name, file_path) to (set_name, files): deletes each file that is there."""
    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        deleted = []
        for uri in batch["file_path"].to_pylist():
            filesystem, path = fs.FileSystem.from_uri(uri)
            there = filesystem.get_file_info(path).type == fs.FileType.File
            if there:
                filesystem.delete_file(path)
            deleted.append(int(there))
        yield pa.RecordBatch.from_arrays([batch[SET], pa.array(deleted, pa.int64())],
                                         [SET, "files"])


class SetTable:
    """Events in folders of daily sets.  Rows without a key or time are in the set of
    their own that Spark names for a null; it never expires."""

    def __init__(self, path: str, key: str = "event_type", ts: str = "ts"):
        self.path, self.key, self.ts = path.rstrip("/"), key, ts

    def write(self, events: DataFrame, part: int = 0) -> None:
        """Writes ``events`` as ``part`` of their sets, in place of an earlier write of
        that part to them."""
        named = events.withColumns({SET: set_name(F.col(self.key), F.col(self.ts)),
                                    PART: F.lit(int(part)).cast("long")})
        (named.hint("rebalance", SET).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(SET, PART)
         .parquet(self.path))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(PART)

    def files(self, spark: SparkSession) -> DataFrame:
        """(set_name, file_path, file_size): the listing, no file is opened."""
        folder = F.regexp_extract("file_path", rf"/{SET}=([^/]*)/", 1)
        # paths are percent-encoded, and folder names are before that
        name = F.try_url_decode(F.try_url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))
        return list_files(spark, self.path).select(name.alias(SET), "file_path", "file_size")

    def sets(self, spark: SparkSession) -> DataFrame:
        """(set_name, files, bytes)."""
        return self.files(spark).groupBy(SET).agg(F.count(F.lit(1)).alias("files"),
                                                  F.sum("file_size").alias("bytes"))

    def sweep(self, spark: SparkSession, prefix: str, days: int, as_of) -> DataFrame:
        """Drops the sets with ``prefix`` whose day is more than ``days`` before ``as_of``;
        returns (sets, files) dropped, which runs the sweep."""
        files = self.files(spark)
        gone = expired_sets(files.select(SET, "file_path"), prefix, days, as_of,
                            columns=(SET, "file_path"))
        dropped = gone.mapInArrow(_delete_files, f"{SET} string, files long")
        return dropped.agg(F.count_distinct(SET).alias("sets"),
                           F.coalesce(F.sum("files"), F.lit(0)).alias("files"))


def retained_sets_stream(source: DataFrame, table: SetTable, checkpoint: str, prefix: str,
                         days: int = 2, available_now: bool = True) -> StreamingQuery:
    """Each micro-batch lands in its sets; then sets that are expired at the newest time
    of the batch are dropped.  Late rows of a dropped set open it again, and the next
    sweep drops it."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table.write(batch, batch_id)
        newest = batch.agg(F.max(F.to_date(table.ts))).first()[0]  # one value
        if newest is not None:
            table.sweep(spark, prefix, days, newest).collect()  # one row

    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
