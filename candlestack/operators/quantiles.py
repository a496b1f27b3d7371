"""Exact, linearly interpolated quantiles without gathering a group.

``percentile`` keeps a value->count map per group and merges it in one task
per group, so one key holding a third of the rows holds a third of the
distinct values in one task.  Here instead:

1. distinct (key, value) pairs with their multiplicity: a partial/final
   aggregate, so a repeated value is counted map-side;
2. a global sort of those pairs (range partitioning from a sample, so a hot
   key is spread over many balanced partitions), written once to the shared
   checkpoint folder with its partition id so both later passes see the same
   partitions;
3. running counts inside each sorted partition (a window over one
   partition's rows) plus per-partition offsets (one row per partition,
   broadcast: its size is bounded by the partition count);
4. per key: total n and first rank; each pair knows the rank interval it
   covers, and keeps only the pairs covering the ranks ``floor(p (n-1))`` and
   ``ceil(p (n-1))`` of each requested ``p`` -- at most two per ``p`` and key.

The result equals ``percentile`` / pandas ``quantile`` (linear).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlestack.operators.series import partition_offsets, sorted_partitions


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float]) -> DataFrame:
    """(keys..., p, quantile) for every key and every p in ``probs``."""
    keys = list(keys)
    v = F.col(f"`{value}`").cast("double")
    pairs = (df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
             .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_m")))
    ordered = sorted_partitions(pairs, [*keys, "_v"], "quantile-sort")
    in_part = Window.partitionBy("_pid").orderBy("_idx")
    local = ordered.withColumn("_end", F.sum("_m").over(
        in_part.rowsBetween(Window.unboundedPreceding, 0)))
    offsets = partition_offsets(ordered, F.col("_m"))
    ranked = (local.join(F.broadcast(offsets), "_pid")
              .withColumn("_end", F.col("_end") + F.col("_off"))
              .withColumn("_start", F.col("_end") - F.col("_m")))
    per_key = ranked.groupBy(*keys).agg(F.sum("_m").alias("_n"),
                                        F.min("_start").alias("_k0"))
    per_key = per_key.select(*[F.col(k).alias(f"_pk_{k}") for k in keys], "_n", "_k0")
    rel = (ranked.join(per_key, [ranked[k].eqNullSafe(per_key[f"_pk_{k}"]) for k in keys])
           .drop(*[f"_pk_{k}" for k in keys])
           .withColumn("_s", F.col("_start") - F.col("_k0"))
           .withColumn("_e", F.col("_end") - F.col("_k0")))
    targets = []
    for p in probs:
        r = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = F.floor(r), F.ceil(r)
        for which, rank in (("lo", lo), ("hi", hi)):
            hit = (F.col("_s") <= rank) & (rank < F.col("_e"))
            targets.append(F.when(hit, F.struct(F.lit(float(p)).alias("p"),
                                                F.lit(which).alias("which"),
                                                (r - lo).alias("frac"))))
    hits = (rel.select(*keys, "_v", F.explode(F.filter(F.array(*targets),
                                                       lambda t: t.isNotNull())).alias("t"))
            .select(*keys, "_v", "t.p", "t.which", "t.frac"))
    got = hits.groupBy(*keys, "p").agg(
        F.max(F.when(F.col("which") == "lo", F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("which") == "hi", F.col("_v"))).alias("_hi"),
        F.max("frac").alias("_f"))
    return got.select(*keys, "p",
                      (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias("quantile"))
