"""Batched external writes with a success / failure tally (W31).

Each Spark task sends its own rows in batches of ``batch_size`` through a
pluggable writer (a picklable callable, e.g. a bulk client of a search index
or time-series store) and yields one tally row per batch; the tallies are
summed per target.  Nothing passes through the driver, and a retried task
re-sends the same batches under the same names, so a keyed target stays
idempotent.

This is the one place where Python runs per partition: client libraries of
external stores are Python, and the batches travel as Arrow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The per-partition code and the default writer are shipped by value, so
# executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TALLY_SCHEMA = "target string, written long, failed long"

Writer = Callable[[str, str, pd.DataFrame], tuple[int, int]]


class JsonLinesWriter:
    """Default writer: each batch becomes one JSON-lines file under
    ``root/<target>/`` named by task partition and batch number (replays
    overwrite).  Uses pyarrow's filesystem layer, so local, HDFS or object
    store URIs work alike."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def __call__(self, target: str, name: str, batch: pd.DataFrame) -> tuple[int, int]:
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(self.root)
        folder = f"{base}/{target}"
        filesystem.create_dir(folder, recursive=True)
        text = batch.to_json(orient="records", lines=True, date_format="iso",
                             default_handler=str)
        with filesystem.open_output_stream(f"{folder}/{name}.jsonl") as f:
            f.write(text.encode())
        return len(batch), 0


def send_in_batches(df: DataFrame, writer: Writer, target_col: str = "_index",
                    batch_size: int = 1000) -> DataFrame:
    """Send every row through ``writer``; return (target, written, failed)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seq = 0
        for frame in frames:
            for target, group in frame.groupby(target_col, sort=False, dropna=False):
                for start in range(0, len(group), batch_size):
                    chunk = group.iloc[start:start + batch_size]
                    name = f"part-{part:05d}-{seq:06d}"
                    seq += 1
                    try:
                        ok, bad = writer(str(target), name, chunk)
                    except Exception:  # a failed batch is counted, not fatal
                        ok, bad = 0, len(chunk)
                    yield pd.DataFrame({"target": [str(target)], "written": [ok],
                                        "failed": [bad]})

    tallies = df.mapInPandas(run, TALLY_SCHEMA)
    return (tallies.groupBy("target")
            .agg(F.sum("written").alias("written"), F.sum("failed").alias("failed")))
