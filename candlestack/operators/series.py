"""Ordered-series windows that do not put a whole series into one task.

A plain ``Window.partitionBy(symbol).orderBy(Date)`` sends every row of a
symbol to one task.  With a handful of symbols (or one symbol holding a third
of the rows) that is one task per series no matter how large the cluster is.

Instead:

1. ``global_positions`` sorts the rows by (series key, order) with a global
   sort.  Spark range-partitions it from a sample of the sort key, and since
   the key is unique the partitions are balanced even when one series holds
   most rows.  The sorted rows are written once to the shared checkpoint
   folder together with their sort partition id and their index inside that
   partition, so every later pass sees the same partitions.  One count per
   sort partition (a table whose size is bounded by the partition count, so
   it is broadcast) turns those into global positions.

2. ``halo_segments`` cuts the global order into segments of ``seg_rows``
   positions and copies the last ``halo`` rows of every segment into the
   next one.  A rolling frame that looks back at most ``halo`` rows of its
   own series then sees exactly the rows it would see over the whole series
   (series are contiguous in the global order, so a row's predecessors in its
   series are among the ``halo`` positions before it).

3. ``series_columns`` evaluates window expressions over
   ``partitionBy(series, segment).orderBy(position)`` and drops the copies.

Results are exactly those of the series-wide window; every task holds at
most ``seg_rows + halo`` rows or one balanced sort partition.

Series that their key bounds (``bounded=True``: daily bars keyed by symbol and
date cannot outnumber the days of history, at any tick volume) use the plain
per-series window instead: one shuffle, no sort or write.  The caller states
this once per operator; nothing is measured and no size switches the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlestack.session import materialize

DEFAULT_SEG_ROWS = 250_000

POS = "_pos"
SEG = "_seg"
HALO = "_halo"
GPOS = "_g"


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def sorted_partitions(df: DataFrame, order: Sequence[str | Column],
                      name: str = "sorted") -> DataFrame:
    """Globally sorted rows, materialised with ``_pid`` (sort partition) and
    ``_idx`` (0-based index inside it, in sort order)."""
    ordered = (df.orderBy(*_cols(order))
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_rid", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition index << 33) + record number
    local = F.col("_rid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return materialize(ordered.withColumn("_idx", local).drop("_rid"), name)


def partition_offsets(parts: DataFrame, weight: Column | None = None) -> DataFrame:
    """(``_pid``, ``_off``): total weight of all earlier sort partitions.
    One row per sort partition: small by construction."""
    w = F.lit(1) if weight is None else weight
    per_part = parts.groupBy("_pid").agg(F.sum(w).alias("_t"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("_pid", F.coalesce(F.sum("_t").over(before), F.lit(0))
                           .cast("long").alias("_off"))


def global_positions(df: DataFrame, order: Sequence[str | Column],
                     pos_col: str = GPOS) -> DataFrame:
    """Add ``pos_col``: 0-based position of each row in the global ``order``
    (which must be a total order for the result to be deterministic)."""
    parts = sorted_partitions(df, order, "positions")
    offsets = F.broadcast(partition_offsets(parts))
    return (parts.join(offsets, "_pid")
            .withColumn(pos_col, F.col("_off") + F.col("_idx"))
            .drop("_pid", "_idx", "_off"))


def position_index(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   pos_col: str = POS, bounded: bool = False) -> DataFrame:
    """Add ``pos_col``: 0-based rank of each row inside its ``keys`` group.

    Global positions minus the group's first position; the per-group minimum
    is a partial/final aggregate, joined back on the keys (AQE broadcasts it
    when small and splits skewed partitions otherwise).  For groups
    that their key bounds (``bounded``) it is a per-group ``row_number``."""
    keys = list(keys)
    if keys and bounded:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.withColumn(pos_col, F.row_number().over(w) - 1)
    g = global_positions(df, [*keys, *order])
    if not keys:
        return g.withColumnRenamed(GPOS, pos_col)
    starts = g.groupBy(*keys).agg(F.min(GPOS).alias("_k0"))
    starts = starts.select(*[F.col(k).alias(f"_sk_{k}") for k in keys], "_k0")
    cond = [g[k].eqNullSafe(starts[f"_sk_{k}"]) for k in keys]
    return (g.join(starts, on=cond, how="inner")
            .withColumn(pos_col, F.col(GPOS) - F.col("_k0"))
            .drop(GPOS, "_k0", *[f"_sk_{k}" for k in keys]))


def halo_segments(indexed: DataFrame, halo: int, seg_rows: int = DEFAULT_SEG_ROWS,
                  pos_col: str = GPOS) -> DataFrame:
    """Assign ``_seg`` and duplicate the last ``halo`` rows into the next segment."""
    size = max(int(seg_rows), int(halo), 1)
    home = F.floor(F.col(pos_col) / F.lit(size))
    if halo <= 0:
        return indexed.withColumns({SEG: home, HALO: F.lit(False)})
    tail = (F.col(pos_col) % F.lit(size)) >= F.lit(size - halo)
    segs = F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))
    return (indexed.withColumn(SEG, F.explode(segs))
            .withColumn(HALO, F.col(SEG) != home))


def series_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   halo: int,
                   stages: Callable[[WindowSpec], list[dict[str, Column]]],
                   seg_rows: int = DEFAULT_SEG_ROWS,
                   bounded: bool = False) -> DataFrame:
    """Add window columns computed over each ordered series.

    ``stages(w)`` returns a list of ``{name: expression}`` dicts evaluated in
    turn over ``w`` (later stages may use earlier columns).  Every frame must
    look back at most ``halo`` rows and never forward.

    Series that their key bounds (``bounded``: daily bars keyed by symbol and
    date) are windowed directly, one task per series; all others are globally sorted and
    cut into halo segments, read once by the materialised sort.
    """
    keys = list(keys)
    if keys and bounded:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        out = df
        for stage in stages(w):
            out = out.withColumns(stage)
        return out
    indexed = global_positions(df, [*keys, *order])
    segmented = halo_segments(indexed, halo, seg_rows)
    w = Window.partitionBy(*keys, SEG).orderBy(GPOS)
    out = segmented
    for stage in stages(w):
        out = out.withColumns(stage)
    return out.where(~F.col(HALO)).drop(GPOS, SEG, HALO)
