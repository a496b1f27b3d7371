"""Logs of partial aggregates: what a stream keeps instead of growing state.

Every micro-batch writes the partial aggregates of its own rows into
``<path>/changes/_batch=<id>`` (overwritten on replay, so a batch counts
once), and a read combines the partials of all batches.  Nothing is held in
the streaming state, so a long-running stream costs what its batches cost.
``compact`` writes the combined partials of all batches so far as a base that
later reads start from.

``ChangeLog`` keeps the latest row of a key; here the rows of a key are
combined: sums add, moments merge, first and last ticks are compared, sketches
are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestack.sinks.upsert import ChangeLog


class PartialLog(ChangeLog):
    """``combine`` takes partials of one key from several batches to one row of
    the same columns; it must be associative, and is a grouped aggregate."""

    def __init__(self, path: str, keys: Sequence[str],
                 combine: Callable[[DataFrame], DataFrame]):
        super().__init__(path, keys)
        self.combine = combine

    def read(self, spark: SparkSession) -> DataFrame:
        raw = self.parts(spark)
        return self.combine(raw.select(*[F.col(f"`{c}`") for c in raw.columns if c != "_batch"]))


def added(keys: Sequence[str], counts: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Combines partial counts and sums by adding them."""

    def combine(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])

    return combine
