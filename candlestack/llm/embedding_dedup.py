"""Embedding near-dedup by sorted projection passes.

In each pass every vector gets a key of concatenated random hashes (signs of
seeded random projections); the vectors of a label are sorted by key and each
is compared with its ``window`` successors.  Near vectors agree in most signs
and so come to stand close in some pass.  All passes are one global sort by
(pass, label, key), which Spark range-partitions, cut into segments of bounded
size that carry the last ``window`` rows of the segment before.

A window is full where more vectors than it holds share the first RUN_BITS
signs of a key, as in a dense label.  Such a run is compared whole, in pairs of
bounded blocks, unless its vectors are one component already.  So a pair is met
at least where it agrees in those signs in some pass: at cosine 0.93 with
probability 1 - (1 - 0.88 ** 8) ** 20 = 0.9998, whatever the size and density.

Verified pairs of all passes are united into components.  The links of a vector are then counted
exactly among all members of its component, in pairs of bounded blocks that
give counts, never pairs.  Equal vectors are one class with a weight from the
start, so a group of copies costs one comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestack.llm.common import materialize, on_workers, on_workers_grouped
from candlestack.llm.components import components
from candlestack.llm.vectors import matrix, usable
from candlestack.operators.series import SEG, global_positions, halo_segments

THRESHOLD = 0.93
PASSES = 20
KEY_BITS = 48
WINDOW = 32
SEGMENT_ROWS = 4_096
BLOCK_ROWS = 1_024
RUN_BITS = 8
RUN_BLOCK_ROWS = 2_048
SEED = 11


def key_batches(batches: Iterator, passes: int, bits: int, seed: int) -> Iterator:
    """(cls, label, embedding) to one row per pass with its key."""
    import pyarrow as pa

    planes: dict = {}
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        rows = batch.num_rows
        keys = np.zeros((rows, passes), np.int64)
        lengths = np.array([len(v) for v in batch["embedding"]], np.int64)
        for dim in np.unique(lengths).tolist():
            if dim not in planes:
                planes[dim] = np.random.default_rng([seed, dim]).normal(size=(dim, passes * bits))
            at = np.flatnonzero(lengths == dim)
            x = matrix(batch["embedding"].take(pa.array(at)))
            x = x / np.abs(x).max(1, keepdims=True)
            keys[at] = ((x @ planes[dim]) > 0).reshape(len(at), passes, bits) @ weights
        take = pa.array(np.repeat(np.arange(rows), passes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(np.arange(passes, dtype=np.int32), rows)),
             batch["label"].take(take), pa.array(keys.ravel()), batch["cls"].take(take),
             batch["embedding"].take(take)], ["pass", "label", "key", "cls", "embedding"])


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n indexes over the edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def window_links(table, window: int, threshold: float):
    """Links of a segment as (class, class of the smallest position reached)."""
    import pyarrow as pa

    table = table.take(pa.array(np.argsort(table["_g"].to_numpy(), kind="stable")))
    group = table["pass"].to_numpy(), table["label"].to_numpy(), table["dim"].to_numpy()
    cls, n = table["cls"].to_numpy(), table.num_rows
    ends: list = [[], []]
    # rows of one dimension stand together within a pass and label
    runs = np.flatnonzero(np.any([np.diff(g, prepend=-1) != 0 for g in group], 0))
    for lo, hi in zip(runs.tolist(), [*runs[1:].tolist(), n]):
        x = unit_rows(matrix(table["embedding"].slice(lo, hi - lo).combine_chunks()))
        for step in range(1, min(window, hi - lo - 1) + 1):
            cos = np.einsum("ij,ij->i", x[:-step], x[step:])
            at = np.flatnonzero(cos >= threshold) + lo
            ends[0].append(at)
            ends[1].append(at + step)
    a, b = (np.concatenate(e) if e else np.zeros(0, np.int64) for e in ends)
    # a class may stand in several passes of the segment
    names, index = np.unique(cls, return_inverse=True)
    root = roots(len(names), index[a], index[b])
    moved = np.flatnonzero(root != np.arange(len(names)))
    return pa.table({"a": pa.array(names[moved]), "b": pa.array(names[root[moved]])})


def block_links(table, threshold: float):
    """Links between two blocks of a run (or within one), as ``window_links``."""
    import pyarrow as pa

    side, cls = table["side"].to_numpy(), table["cls"].to_numpy()
    x = unit_rows(matrix(table["embedding"].combine_chunks()))
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(two):
        two = one
    a, b = np.nonzero((x[one] @ x[two].T) >= threshold)
    root = roots(len(cls), one[a], two[b])
    moved = np.flatnonzero(root != np.arange(len(cls)))
    return pa.table({"a": pa.array(cls[moved]), "b": pa.array(cls[root[moved]])})


def block_pairs() -> Column:
    """The pairs of blocks in which a row of ``block`` of ``blocks`` stands."""
    return F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("block")).alias("bi"), F.greatest(o, F.col("block")).alias("bj"),
        F.when(F.col("block") <= o, 0).otherwise(1).alias("side")))


def full_window_links(placed: DataFrame, classes: DataFrame, member: DataFrame, window: int,
                      shift: int, block_rows: int, threshold: float) -> DataFrame:
    """Links within the runs of one key prefix that are longer than a window
    and hold classes of different components."""
    run = ["pass", "label", "dim", "prefix"]
    # no vector moves until the blocks are known
    keys = placed.select("pass", "label", "dim", F.shiftright("key", shift).alias("prefix"), "cls")
    long_ = keys.groupBy(*run).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > window + 1)
    rows = (keys.join(long_, run).join(member.withColumnRenamed("node", "cls"), "cls", "left")
            .withColumn("component", F.coalesce("component", "cls")))
    mixed = (rows.groupBy(*run, "m").agg(F.min("component").alias("c0"),
                                         F.max("component").alias("c1"))
             .where("c0 <> c1")
             .select(*run, F.ceil(F.col("m") / block_rows).cast("int").alias("blocks")))
    return (keys.join(mixed, run)
            .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
            .select(*run, "cls", F.explode(block_pairs()).alias("p"))
            .select(*run, "cls", "p.*")
            .join(classes.select("cls", "embedding"), "cls")
            .groupBy(*run, "bi", "bj")
            .applyInArrow(on_workers_grouped("embedding_dedup", "block_links", threshold),
                          "a long, b long"))


def block_counts(table, threshold: float):
    """Weights of the links between two blocks of a component (or within one)."""
    import pyarrow as pa

    side, cls = table["side"].to_numpy(), table["cls"].to_numpy()
    weight, x = table["weight"].to_numpy(), unit_rows(matrix(table["embedding"].combine_chunks()))
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    within = not len(two)
    if within:
        two = one
    linked = (x[one] @ x[two].T) >= threshold
    if within:
        np.fill_diagonal(linked, False)
    names, sums = [cls[one]], [linked @ weight[two]]
    if not within:
        names.append(cls[two])
        sums.append(linked.T @ weight[one])
    return pa.table({"cls": pa.array(np.concatenate(names)),
                     "links": pa.array(np.concatenate(sums).astype(np.int64))})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES,
                    window: int = WINDOW, key_bits: int = KEY_BITS,
                    segment_rows: int = SEGMENT_ROWS, block_rows: int = BLOCK_ROWS,
                    run_bits: int = RUN_BITS, run_block_rows: int = RUN_BLOCK_ROWS,
                    seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``
    (vec_id, embedding, label).

    Two rows link when their labels are equal and not null, their embeddings
    have one length and their cosine is at least ``threshold``.  Vectors that
    are null, empty, zero or hold null or non-finite components link with
    nothing (n_links 0, component_id their vec_id), nor do rows of null label.
    Equal vectors of a label link; repeated rows count as vectors of their
    own.  component_id is the smallest vec_id reachable, ``kept`` whether that
    is the row's own.  A null vec_id takes part, names no component and is
    never kept.  An empty table gives an empty table; other columns are
    ignored."""
    base = vectors.select("vec_id", "label", "embedding")
    valid = base.where(F.col("label").isNotNull() & usable(F.col("embedding")))
    cls = F.xxhash64("label", "embedding")
    classes = materialize(
        valid.groupBy(cls.alias("cls")).agg(
            F.min("label").cast("int").alias("label"), F.min("embedding").alias("embedding"),
            F.count(F.lit(1)).alias("weight")), "classes")
    keyed = classes.select("cls", "label", "embedding").mapInArrow(
        on_workers("embedding_dedup", "key_batches", passes, key_bits, seed),
        "pass int, label int, key long, cls long, embedding array<"
        + classes.schema["embedding"].dataType.elementType.simpleString() + ">")
    keyed = keyed.withColumn("dim", F.size("embedding"))
    placed = global_positions(keyed, ["pass", "label", "dim", "key", "cls"])
    links = (halo_segments(placed, window, segment_rows).groupBy(SEG)
             .applyInArrow(on_workers_grouped("embedding_dedup", "window_links", window,
                                              threshold), "a long, b long"))
    member = materialize(components(links), "members")
    more = materialize(full_window_links(placed, classes, member, window,
                                         key_bits - min(run_bits, key_bits), run_block_rows,
                                         threshold), "run-links")
    if not more.isEmpty():
        member = materialize(components(
            member.select(F.col("node").alias("a"), F.col("component").alias("b"))
            .unionAll(more)), "members")

    # exact link counts inside every component
    inside = classes.join(member.withColumnRenamed("node", "cls"), "cls")
    blocks = (member.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
              .select("component", F.ceil(F.col("m") / block_rows).cast("int").alias("blocks")))
    inside = (inside.join(blocks, "component")
              .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")))
    counted = (inside.select("component", "cls", "weight", "embedding",
                             F.explode(block_pairs()).alias("p"))
               .select("component", "p.*", "cls", "weight", "embedding")
               .groupBy("component", "bi", "bj")
               .applyInArrow(on_workers_grouped("embedding_dedup", "block_counts", threshold),
                             "cls long, links long")
               .groupBy("cls").agg(F.sum("links").alias("links")))

    rows = base.select("vec_id", F.when(F.col("label").isNotNull()
                                        & usable(F.col("embedding")), cls).alias("cls"))
    named = (rows.join(classes.select("cls", "weight"), "cls", "left")
             .join(member.withColumnRenamed("node", "cls"), "cls", "left")
             .join(counted, "cls", "left")
             .withColumn("component", F.coalesce("component", "cls")))
    least = (named.where("component is not null").groupBy("component")
             .agg(F.min("vec_id").alias("least")))
    n_links = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))
    out = named.join(least, "component", "left").select(
        "vec_id", n_links.cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                             F.lit(False)))
