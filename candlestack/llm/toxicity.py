"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>) over the hashed terms i
present in a text, so that pairs of terms (an insult next to the mention of a
group) count on their own, which additive weights cannot express.

Training takes a bounded, seeded sample of labelled rows (``max_rows``; the
sample of ids is broadcast, at most 16 bytes a row).  The terms of these rows
are hashed on the executors, counted by label, and the ``n_features`` buckets
with the largest likelihood ratio against the label become the features; the
rows, reduced to those features (at most max_rows x n_features bits), are
fitted on the driver by mini-batch Adam.  Scoring is one pass over all
documents with the model (n_features weights) broadcast: no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestack.llm.common import materialize, no_null_text, on_workers, slices

MAX_ROWS = 20_000
N_FEATURES = 512
BUCKET_BITS = 20
FACTORS = 4
THRESHOLD = 0.7
EDGE = ".,;:!?\"'()[]{}<>*#%&$|"


@dataclass
class Model:
    """Weights of the features; ``buckets`` their hash buckets, ascending."""

    buckets: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray
    bits: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.v
        return self.w0 + x @ self.w + 0.5 * ((s * s).sum(1) - x @ (self.v * self.v).sum(1))


def terms(text: str) -> set:
    """The words of a text, and the first four letters of longer words, under
    which inflected and compound forms of one insult meet."""
    words = {w.strip(EDGE) for w in set(text.lower().split())}
    words.discard("")
    return words | {"^" + w[:4] for w in words if len(w) > 5}


def buckets_of(text: str, bits: int) -> set:
    mask = (1 << bits) - 1
    return {zlib.crc32(t.encode()) & mask for t in terms(text)}


def bucket_batches(batches: Iterator, bits: int) -> Iterator:
    import pyarrow as pa

    for batch in slices(batches):
        found = [sorted(buckets_of(t, bits)) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["label"], pa.array(found, pa.list_(pa.int32()))], ["label", "buckets"])


def score_batches(batches: Iterator, weights: dict) -> Iterator:
    import pyarrow as pa

    model = Model(**weights)
    index = {int(b): i for i, b in enumerate(model.buckets)}
    known = index.keys()
    for batch in slices(batches):
        texts = batch["text"].to_pylist()
        x = np.zeros((len(texts), len(index)), np.float64)
        for row, text in enumerate(texts):
            for b in known & buckets_of(text, model.bits):
                x[row, index[b]] = 1
        score = 1 / (1 + np.exp(-np.clip(model.margin(x), -60, 60)))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], ["doc_id", "score"])


def fit(x: np.ndarray, y: np.ndarray, factors: int = FACTORS, seed: int = 7, steps: int = 2_000,
        batch: int = 512, rate: float = 0.02, decay: float = 1e-5) -> tuple:
    """(w0, w, v) by mini-batch Adam on the logistic loss."""
    rng = np.random.default_rng(seed)
    n, m = x.shape
    mean = float(y.mean()) if n else 0.0
    w0 = np.array([np.log((mean + 1e-3) / (1 - mean + 1e-3))])
    params = [w0, np.zeros(m), rng.normal(0, 0.01, (m, factors))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    while n and m and step < steps:
        order = rng.permutation(n)
        for at in range(0, n, batch):
            rows = order[at:at + batch]
            xb, yb = x[rows].astype(np.float64), y[rows]
            s = xb @ params[2]
            z = params[0] + xb @ params[1] + 0.5 * ((s * s).sum(1) - xb @ (params[2] ** 2).sum(1))
            g = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - yb) / len(rows)
            grads = [np.array([g.sum()]), xb.T @ g + decay * params[1],
                     xb.T @ (g[:, None] * s) - (xb.T @ g)[:, None] * params[2]
                     + decay * params[2]]
            step += 1
            for p, d, a, b in zip(params, grads, first, second):
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return float(params[0][0]), params[1], params[2]


def held_out(doc_id: Column) -> Column:
    """The fold kept from training: crc32 of the id as text, mod 3, is 1 (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
          n_features: int = N_FEATURES, bits: int = BUCKET_BITS, seed: int = 7) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0/1).

    Rows with a null id or label teach nothing; an id labelled more than once
    is toxic if any label says so; rows alike in id and text count once, and of
    ids with several texts at most ``max_rows`` rows are fitted.  Without any labelled row every score is 0.5."""
    known = (labels.select("doc_id", "label").dropna().groupBy("doc_id")
             .agg(F.max("label").cast("double").alias("label")))
    chosen = (known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_rows)
              .select(F.col("doc_id").alias("_id"), "label"))
    rows = (docs.select("doc_id", no_null_text("text").alias("text"))
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # at most max_rows rows
            .dropDuplicates(["_id", "text"]).select("label", "text"))
    hashed = materialize(rows.mapInArrow(on_workers("toxicity", "bucket_batches", bits),
                                         "label double, buckets array<int>"), "hashed")
    n, pos = hashed.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n:
        return Model(np.zeros(0, np.int64), 0.0, np.zeros(0), np.zeros((0, 1)), bits)
    counts = (hashed.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket")
              .agg(F.sum("label").alias("a"), F.count(F.lit(1)).alias("t")))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, t = F.col("a"), F.col("t")
    rate = F.lit(pos / n)
    ratio = (part(a, t * rate) + part(t - a, t * (1 - rate))
             + part(F.lit(pos) - a, (F.lit(float(n)) - t) * rate)
             + part(F.lit(n - pos) - (t - a), (F.lit(float(n)) - t) * (1 - rate)))
    best = (counts.where("t >= 3").orderBy(ratio.desc(), "bucket").limit(n_features)
            .select("bucket").collect())  # at most n_features
    buckets = np.array(sorted(r.bucket for r in best), np.int64)
    kept = hashed.orderBy(F.xxhash64("buckets", F.lit(seed)), "label").limit(max_rows).select(
        "label", F.array_intersect("buckets", F.lit(buckets.tolist()).cast(
            "array<int>")).alias("buckets")).collect()  # at most max_rows x n_features ids
    x = np.zeros((len(kept), len(buckets)), np.float32)
    y = np.zeros(len(kept))
    for i, r in enumerate(sorted(kept, key=lambda r: (r.label, r.buckets))):
        x[i, np.searchsorted(buckets, r.buckets)] = 1
        y[i] = r.label
    w0, w, v = fit(x, y, seed=seed)
    return Model(buckets, w0, w, v, bits)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs``: 0 to 1, higher is more
    likely toxic.  Null and empty texts have no terms and get the base score;
    very long texts are read whole; repeated rows are scored each; an empty
    table gives an empty table; other columns are ignored."""
    return docs.select("doc_id", no_null_text("text").alias("text")).mapInArrow(
        on_workers("toxicity", "score_batches", vars(model)), "doc_id long, score double")


def rejected(score_col: Column, threshold: float = THRESHOLD) -> Column:
    return score_col >= F.lit(threshold)


def keep_clean_batches(batches: Iterator, weights: dict, threshold: float) -> Iterator:
    import pyarrow as pa

    for batch in slices(batches):
        texts = pa.RecordBatch.from_arrays(
            [pa.nulls(batch.num_rows, pa.int64()),
             pa.array([t or "" for t in batch["text"].to_pylist()], pa.string())],
            ["doc_id", "text"])
        scored = next(score_batches(iter([texts]), weights))
        yield batch.filter(pa.array(scored["score"].to_numpy() < threshold))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all their columns,
    in one pass (``text`` must be among the columns)."""
    names = [f"c{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    plain = docs.toDF(*names)
    out = plain.mapInArrow(on_workers("toxicity", "keep_clean_batches", vars(model), threshold),
                           plain.schema)
    return out.toDF(*docs.columns)
