"""Approximate nearest neighbours over balanced posting lists.

Index: a bounded sample of the vectors is cut into balanced clusters whose
means are the centroids.  The centroids form a neighbour graph in memory, and
every vector finds its lists by searching that graph: its nearest centroid,
and, as a boundary vector, also the other centroids whose distance is within
``replica_ratio`` of the nearest (``replicas`` lists at most; the nearest
alone holds it for certain, the others are copies).  Lists longer than
``block_rows`` are split into blocks, so no task holds a whole long list.

Search: a query walks the graph and selects every list whose centroid is
within ``probe_ratio`` of its nearest one, and more, in order of distance,
until the selected lists are certain to hold enough vectors.  Blocks and the
queries that selected them meet by a cogrouped shuffle on (list, block,
query block); each block yields its best candidates for each query, in exact
double precision on the original vectors, and a last window merges them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlestack.llm.common import materialize, on_workers
from candlestack.llm.vectors import matrix, usable

#: Vectors in the sample that the centroids are fitted on.
FIT_ROWS = 20_000
#: Vectors aimed at in a list; lists at most (bounds the broadcast centroids).
LIST_ROWS = 128
MAX_LISTS = 2_048
REPLICAS = 8
REPLICA_RATIO = 1.08
PROBE_RATIO = 1.12
DEGREE = 16
BLOCK_ROWS = 2_048
QUERY_ROWS = 1_024


@dataclass
class Centroids:
    """Centroids, their neighbour graph (a row of ids each) and entry points."""

    points: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    dim: int

    def search(self, x: np.ndarray, keep: int, ratio: float) -> np.ndarray:
        """Distances to the centroids reached from the entry points by way of
        nodes that are among the ``keep`` nearest so far or within ``ratio``
        of the nearest; infinite for those not reached."""
        n, k = len(x), len(self.points)
        square = (self.points ** 2).sum(1)
        own = (x ** 2).sum(1)
        dist = np.full((n, k), np.inf)
        open_ = np.zeros((n, k), bool)

        def visit(rows, cols):
            d = own[rows] + square[cols] - 2 * np.einsum("ij,ij->i", x[rows], self.points[cols])
            dist[rows, cols] = np.sqrt(np.maximum(d, 0))
            open_[rows, cols] = True

        visit(np.repeat(np.arange(n), len(self.entries)), np.tile(self.entries, n))
        keep = min(keep, k)
        while True:
            bound = np.maximum(dist.min(1) * ratio, np.partition(dist, keep - 1, 1)[:, keep - 1])
            rows, cols = np.nonzero(open_ & (dist <= bound[:, None]))
            if not len(rows):
                return dist
            open_[rows, cols] = False
            near = np.zeros((n, k), bool)
            near[np.repeat(rows, self.graph.shape[1]), self.graph[cols].ravel()] = True
            near &= np.isinf(dist)
            visit(*np.nonzero(near))


def balanced_split(x: np.ndarray, lists: int, seed: int) -> list:
    """Means of ``lists`` clusters of equal size (but for rounding): halve by
    the quantile along the line through two 2-means centres, again and again."""
    if lists <= 1 or len(x) < 2:
        return [x.mean(0)]
    rng = np.random.default_rng(seed)
    a, b = x[rng.choice(len(x), 2, replace=False)]
    left = lists // 2
    cut = max(1, min(len(x) - 1, len(x) * left // lists))
    for _ in range(8):
        order = np.argsort(((x - a) ** 2).sum(1) - ((x - b) ** 2).sum(1), kind="stable")
        a, b = x[order[:cut]].mean(0), x[order[cut:]].mean(0)
    return (balanced_split(x[order[:cut]], left, seed + 1)
            + balanced_split(x[order[cut:]], lists - left, seed + 2))


def fit_centroids(sample: np.ndarray, lists: int, degree: int = DEGREE,
                  seed: int = 3) -> Centroids:
    lists = max(1, min(lists, MAX_LISTS, len(sample) // 4 or 1))
    points = np.array(balanced_split(sample, lists, seed))
    k = len(points)
    d = ((points ** 2).sum(1)[:, None] + (points ** 2).sum(1) - 2 * points @ points.T)
    np.fill_diagonal(d, -1)
    near = np.argsort(d, 1, kind="stable")[:, 1:min(degree, k - 1) + 1]
    ring = np.stack([(np.arange(k) + 1) % k, (np.arange(k) - 1) % k], 1)  # keeps it connected
    graph = np.concatenate([near, ring], 1)
    entries = np.unique(np.linspace(0, k - 1, min(k, 8)).astype(int))
    return Centroids(points, graph, entries, sample.shape[1])


def assign_batches(batches: Iterator, centroids: dict, replicas: int, ratio: float) -> Iterator:
    """(vec_id, embedding) to its posting rows (list, rank 0 = nearest)."""
    import pyarrow as pa

    index = Centroids(**centroids)
    for batch in batches:
        ids, x = batch["vec_id"], matrix(batch["embedding"])
        lists, ranks, rows = [], [], []
        for at in range(0, len(x), 1024):
            dist = index.search(x[at:at + 1024], 2 * replicas, ratio)
            order = np.argsort(dist, 1, kind="stable")[:, :replicas]
            d = np.take_along_axis(dist, order, 1)
            r, c = np.nonzero((d <= d[:, :1] * ratio) & np.isfinite(d))
            rows.append(r + at)
            lists.append(order[r, c])
            ranks.append(c)
        pick = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        take = pa.array(pick, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids.take(take), batch["embedding"].take(take),
             pa.array(np.concatenate(lists) if lists else [], pa.int32()),
             pa.array(np.concatenate(ranks) if ranks else [], pa.int32())],
            ["vec_id", "embedding", "list", "rank"])


def probe_batches(batches: Iterator, centroids: dict, sizes: np.ndarray, k: int,
                  ratio: float) -> Iterator:
    """(vec_id, embedding) of queries to (list) rows: all lists within the
    ratio, and more until their certain vectors outnumber k and the query."""
    import pyarrow as pa

    index = Centroids(**centroids)
    for batch in batches:
        x = matrix(batch["embedding"])
        rows, lists = [], []
        for at in range(0, len(x), 512):
            dist = index.search(x[at:at + 512], 64, ratio)
            order = np.argsort(dist, 1, kind="stable")
            d = np.take_along_axis(dist, order, 1)
            held = np.cumsum(sizes[order], 1) - sizes[order]  # vectors in the lists before
            r, c = np.nonzero(((d <= d[:, :1] * ratio) | (held < k + 1)) & np.isfinite(d))
            rows.append(r + at)
            lists.append(order[r, c])
        pick = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"].take(pick), batch["embedding"].take(pick),
             pa.array(np.concatenate(lists) if lists else [], pa.int32())],
            ["query_id", "embedding", "list"])


def block_best(key, queries, vectors, k: int):
    """The k nearest vectors of a block for each of its queries, without the
    query's own row; ties to the smaller vec_id."""
    import pyarrow as pa

    names = ["query_id", "vec_id", "score"]
    q, v = matrix(queries["embedding"]), matrix(vectors["embedding"])
    qid = np.asarray(queries["query_id"].to_numpy())
    vid = np.asarray(vectors["vec_id"].to_numpy())
    out: list = [[], [], []]
    if len(q) and len(v):
        order = np.argsort(vid, kind="stable")
        v, vid = v[order], vid[order]
        step = max(1, 2_000_000 // (v.size or 1))
        for at in range(0, len(q), step):
            # not by the dot product: the sum of squared differences is exact for near copies
            d = np.sqrt(((q[at:at + step, None, :] - v[None]) ** 2).sum(2))
            d[qid[at:at + step, None] == vid[None]] = np.inf
            best = np.argsort(d, 1, kind="stable")[:, :k]
            near = np.take_along_axis(d, best, 1)
            r, c = np.nonzero(np.isfinite(near))
            out[0].append(qid[at:at + step][r])
            out[1].append(vid[best[r, c]])
            out[2].append(near[r, c])
    kinds = [pa.int64(), pa.int64(), pa.float64()]
    return pa.table([pa.array(np.concatenate(o) if o else [], t) for o, t in zip(out, kinds)],
                    names=names)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, fit_rows: int = FIT_ROWS,
            list_rows: int = LIST_ROWS, replicas: int = REPLICAS,
            replica_ratio: float = REPLICA_RATIO, probe_ratio: float = PROBE_RATIO,
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
            seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` nearest rows
    of ``vectors`` found, by Euclidean distance, nearest first, ties to the
    smaller vec_id; rows with the query's own vec_id are no candidates.

    Both tables have vec_id and embedding.  Vectors that are null, empty, zero
    or hold null or non-finite components take no part, nor do rows without a
    vec_id or of another dimension than most vectors have (ties: the
    smaller).  Rows that repeat a vec_id count once, with the embedding that
    sorts first.  A query always finds all candidates when there are no more
    than ``k``.  An empty table gives an empty table; other columns are
    ignored."""
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return (df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
                .where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
                .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))

    all_rows = materialize(clean(vectors), "vectors")
    shape = (all_rows.groupBy(F.size("embedding").alias("dim"))
             .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "dim").first())
    schema = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], schema)
    all_rows = all_rows.where(F.size("embedding") == shape.dim)
    asked = clean(queries).where(F.size("embedding") == shape.dim)
    sample = (all_rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(fit_rows)
              .select("embedding").collect())  # at most fit_rows vectors
    index = fit_centroids(np.array([r.embedding for r in sample], np.float64),
                          -(-shape.n // list_rows), seed=seed)

    posted = materialize(all_rows.mapInArrow(
        on_workers("ann", "assign_batches", vars(index), replicas, replica_ratio),
        "vec_id long, embedding array<double>, list int, rank int"), "postings")
    # one row per list: at most MAX_LISTS
    lengths = (posted.groupBy("list").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("rank") == 0).cast("int")).alias("own"))
        .collect())
    sizes = np.zeros(len(index.points), np.int64)
    for r in lengths:
        sizes[r.list] = r.own
    probes = materialize(asked.mapInArrow(
        on_workers("ann", "probe_batches", vars(index), sizes, k, probe_ratio),
        "query_id long, embedding array<double>, list int"), "probes")
    wanted = probes.groupBy("list").agg(F.count(F.lit(1)).alias("q"))
    blocks = (spark.createDataFrame([(r.list, r.n) for r in lengths], "list int, n long")
              .join(wanted, "list")
              .select("list", F.ceil(F.col("n") / block_rows).cast("int").alias("n_blocks"),
                      F.ceil(F.col("q") / query_rows).cast("int").alias("q_blocks")))
    blocks = F.broadcast(blocks)  # one row per list

    def spread(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = (probes.join(blocks, "list")
            .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("q_blocks")).cast("int"))
            .withColumn("vb", spread("n_blocks")).select("list", "vb", "qb", "query_id",
                                                         "embedding"))
    right = (posted.join(blocks, "list")
             .withColumn("vb", F.pmod(F.xxhash64("vec_id"), F.col("n_blocks")).cast("int"))
             .withColumn("qb", spread("q_blocks")).select("list", "vb", "qb", "vec_id",
                                                          "embedding"))
    fn = on_workers("ann", "block_best", k)

    def best(key, q, v):
        return fn(key, q, v)

    keys = ["list", "vb", "qb"]
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInArrow(best, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
