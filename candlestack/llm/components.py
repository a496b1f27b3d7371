"""Connected components of an edge table, entirely in DataFrames.

Alternating large-star and small-star rounds: every round rewires each node
to the smallest node among its neighbours, once through its larger and once
through its smaller neighbours, until no edge changes.  Each round is two
grouped minimums (combined before the shuffle) joined back on the node, so a
node with very many neighbours is a skewed join that Spark may split, never a
collected group.  Rounds are cut by written tables in the shared checkpoint
folder; only two numbers per round (edge count and checksum) reach the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestack.llm.common import materialize

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over undirected edges given once each as (a, b), a > b."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = (around.groupBy("u").agg(F.min("v").alias("m0"))
             .select("u", F.least("m0", "u").alias("m")))
    linked = around.join(least, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long; any direction, repeats and loops allowed) to
    (node, component): component is the smallest node reachable.  Nodes
    without an edge to another node are absent; an empty table gives an empty
    table."""
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(),
                    "edges")
    before = _mark(e)
    for _ in range(MAX_ROUNDS):
        e = materialize(_star(_star(e, True), False), "stars")
        after = _mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node")).distinct()
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionAll(roots.select("node", F.col("node").alias("component"))))
