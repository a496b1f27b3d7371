"""Importance resampling towards a target distribution, ranked by a parallel
sort by regular sampling.

Features are runs of one to three words, hashed to buckets by crc32.  Counts
of the corpus and of the target are two arrays over the buckets; each task
counts its texts into such an array, so a shuffle sees at most BUCKETS rows a
task.  The arrays give a gain for each bucket, and a document's weight is the
sum of the gains of its features.  A seeded Gumbel term makes the highest
scores a sample without replacement.

The ranks come from a sort in the classical four steps:

1. every task sorts its rows locally and writes them as a run, with positions;
2. regular samples of all runs, each standing for as many rows, are sorted,
   and regular splitters are taken from them;
3. each run's rows go to the segment between two splitters; a segment's pieces
   are sorted runs that its task merges;
4. the segments' counts, summed from the left, are the offsets of their ranks.

Rows are compared by score, doc_id, features and last by run and position, so
no two are equal and even one document in a third of all rows is split evenly.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestack.llm.common import materialize, no_null_text, on_workers

BUCKETS = 10_000
GRAMS = 3
#: Documents with fewer words are not drawn.
MIN_WORDS = 20
#: Percent of the others that are drawn.
PERCENT = 5
SEED = 42
#: Text whose words are hashed at once.
PIECE_BYTES = 1 << 20
#: Regular samples that reach the driver, whatever the number of rows.
MAX_SAMPLES = 1 << 20
#: Rows of a segment that one task merges, about.
SEGMENT_ROWS = 1_000_000

#: Bytes of words: digits, a-z and all of non-ASCII characters; A-Z lower.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


# --- crc32 of many strings ----------------------------------------------------------

def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()
#: Steps by which a crc can be carried over that many bytes in one lookup.
_STEPS = 64


def _step(crc: np.ndarray) -> np.ndarray:
    return _CRC[crc & 255] ^ (crc >> np.uint32(8))


def _shift_table() -> np.ndarray:
    one = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [one]
    for _ in range(_STEPS - 1):
        out.append(_step(out[-1]))
    return np.stack(out).reshape(-1)


_SHIFT = _shift_table()


def carried(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What the crcs of left parts add to those of texts whose right parts have
    ``sizes`` bytes."""
    crc, left = crc.copy(), sizes.astype(np.int64)
    todo = np.flatnonzero(left)
    while len(todo):
        step = np.minimum(left[todo], _STEPS - 1)
        x, base = crc[todo], step * 1024
        crc[todo] = (_SHIFT[base + (x & 255)] ^ _SHIFT[base + 256 + ((x >> 8) & 255)]
                     ^ _SHIFT[base + 512 + ((x >> 16) & 255)] ^ _SHIFT[base + 768 + (x >> 24)])
        left[todo] -= step
        todo = todo[left[todo] > 0]
    return crc


def word_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of the bytes from ``starts`` to ``ends``."""
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, _STEPS + 1), kind="stable")
    at, size = starts[order], sizes[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    counts = np.searchsorted(-np.minimum(size, _STEPS + 1), -np.arange(_STEPS))
    for k, n in enumerate(counts.tolist()):  # n: words longer than k
        if not n:
            break
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + k]) & 255] ^ (crc[:n] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~crc
    for i in np.flatnonzero(sizes > _STEPS):
        out[i] = zlib.crc32(data[starts[i]:ends[i]])
    return out


# --- features -----------------------------------------------------------------------

def _piece_features(data: np.ndarray, bounds: np.ndarray) -> tuple:
    """(text, word number within the piece, buckets of the runs that end with it) of
    all words; a bucket of -1 is a run that the text does not hold."""
    inside = _INSIDE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    text = np.searchsorted(bounds, starts, side="right") - 1
    crc = word_crcs(data, starts, ends)
    sizes = ends - starts
    out = np.full((len(crc), GRAMS), -1, np.int64)
    run = crc
    for k in range(GRAMS):
        if k:
            spaced = ~_step(~run[:-1] ^ np.uint32(32))
            run = carried(spaced, sizes[k:]) ^ crc[k:]
        whole = text[k:] == text[:len(text) - k]
        out[k:, k][whole] = (run % np.uint32(BUCKETS))[whole]
    return text, out


def features(texts: list) -> Iterator[tuple]:
    """(text number, buckets) of the words of ``texts`` (bytes), in pieces; a long
    text is cut between words and its pieces overlap by two words."""
    at = 0
    while at < len(texts):
        size, stop = len(texts[at]), at + 1
        while stop < len(texts) and size + len(texts[stop]) <= PIECE_BYTES:
            size += len(texts[stop])
            stop += 1
        data = _LOWER[np.frombuffer(b"\n".join([*texts[at:stop], b""]), np.uint8)]
        if size <= PIECE_BYTES:
            bounds = np.cumsum([0, *(len(t) + 1 for t in texts[at:stop])])
            text, buckets = _piece_features(data, bounds)
            yield text + at, buckets
        else:  # one long text
            gaps = np.flatnonzero(~_INSIDE[data])
            begin, kept, end, done = 0, 0, 0, False
            while not done:
                cut = np.searchsorted(gaps, max(begin + PIECE_BYTES, end))
                done = cut >= len(gaps) - 1
                end = len(data) if done else int(gaps[cut]) + 1
                text, buckets = _piece_features(data[begin:end], np.array([0]))
                yield text[kept:] + at, buckets[kept:]
                # the next piece begins with the last two words of this one
                edge = np.flatnonzero(np.diff(_INSIDE[data[begin:end]], prepend=False)) + begin
                edge = edge[_INSIDE[data[edge]]]
                kept = min(GRAMS - 1, len(edge))
                begin = int(edge[-kept]) if kept else end
        at = stop


def _texts(batch) -> list:
    return [t.as_buffer().to_pybytes() for t in batch["text"]]


def count_batches(batches: Iterator) -> Iterator:
    """Texts to (bucket, n): one array of counts for the whole task."""
    import pyarrow as pa

    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, buckets in features(_texts(batch)):
            counts += np.bincount(buckets[buckets >= 0], minlength=BUCKETS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all ``texts`` (text) by bucket."""
    rows = (texts.select(no_null_text("text").cast("binary").alias("text"))
            .mapInArrow(on_workers("resampling", "count_batches"), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) by bucket."""
    s_all, t_all = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh_batches(batches: Iterator, gain: np.ndarray) -> Iterator:
    """(doc_id, text) to doc_id, n_words, n_features, weight."""
    import pyarrow as pa

    padded = np.append(gain, 0)  # -1: no feature
    for batch in batches:
        n = batch.num_rows
        words, found, weight = (np.zeros(n, np.int64) for _ in range(3))
        for text, buckets in features(_texts(batch)):
            words += np.bincount(text, minlength=n)
            np.add.at(found, text, (buckets >= 0).sum(1))
            np.add.at(weight, text, padded[buckets].sum(1))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(words), pa.array(found), pa.array(weight)],
            ["doc_id", "n_words", "n_features", "weight"])


def gumbel(seed: int):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256("seed:doc_id")."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


# --- sort by regular sampling ---------------------------------------------------------

#: The order of rows, and its columns as numpy sorts them.
KEY = ["down", "last", "id", "n_features", "run", "pos"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"down": -F.col("score"), "last": F.col("doc_id").isNull().cast("int"),
                             "id": F.coalesce("doc_id", F.lit(0))})


def sorted_runs(rows: DataFrame) -> DataFrame:
    """``rows`` sorted within each task and written, with run and position."""
    place = F.monotonically_increasing_id()
    local = rows.sortWithinPartitions(
        F.col("n_words") < MIN_WORDS, F.desc("score"), F.asc_nulls_last("doc_id"), "n_features")
    return materialize(local.withColumn("place", place).select(
        "*", F.shiftright("place", 33).alias("run"),
        F.col("place").bitwiseAND((1 << 33) - 1).alias("pos")).drop("place"), "runs")


def splitters(rows: DataFrame, sizes: dict, segments: int) -> list:
    """``segments`` - 1 keys that cut ``rows`` (runs of ``sizes``) evenly: with s
    samples a run a segment holds at most n / segments + n / s rows."""
    each = max(16, min(4 * segments, MAX_SAMPLES // max(1, len(sizes))))
    steps = rows.sparkSession.createDataFrame(
        [(r, -(-n // each)) for r, n in sizes.items()], "run long, step long")
    found = (rows.join(F.broadcast(steps), "run").where(F.col("pos") % F.col("step") == 0)
             .select(*KEY, "step").collect())
    found = sorted(tuple(r) for r in found)
    total = sum(sizes.values())
    out, seen = [], 0
    for *key, step in found:
        if len(out) < segments - 1 and seen * segments >= (len(out) + 1) * total:
            out.append(tuple(key))
        seen += step
    return out


def segment_batches(batches: Iterator, cuts: list) -> Iterator:
    """Adds the number of cuts not above a row."""
    import pyarrow as pa

    edges = np.array(cuts, np.int64).reshape(-1, len(KEY))
    for batch in batches:
        own = np.stack([batch[k].to_numpy().astype(np.int64) for k in KEY], 1)
        both = np.concatenate([edges, own])  # stable: a cut stands before its equal
        order = np.lexsort(both.T[::-1])
        segment = np.empty(len(both), np.int64)
        segment[order] = np.cumsum(order < len(edges))
        yield batch.append_column("segment", pa.array(segment[len(edges):].astype(np.int32)))


def rank_batches(batches: Iterator, offsets: list) -> Iterator:
    """Rows in order, segment by segment, to rows with ranks."""
    import pyarrow as pa

    seen: dict[int, int] = {}
    for batch in batches:
        segment = batch["segment"].to_numpy()
        rank = np.empty(len(segment), np.int64)
        for s in np.unique(segment).tolist():
            here = segment == s
            n = int(here.sum())
            first = seen.get(s, offsets[s])
            rank[here] = np.arange(first + 1, first + n + 1)
            seen[s] = first + n
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["n_features"], batch["weight"], batch["score"],
             pa.array(rank)], ["doc_id", "n_features", "weight", "score", "rank"])


def ranked(rows: DataFrame) -> tuple:
    """``rows`` (of ``sorted_runs``) with exact ranks from 1, and their number."""
    spark = rows.sparkSession
    rows = _keyed(rows)
    # one row a task: bounded by the number of partitions
    sizes = {r["run"]: r["n"] for r in rows.groupBy("run").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                   -(-total // SEGMENT_ROWS))
    cuts = splitters(rows, sizes, segments)
    dealt = rows.mapInArrow(on_workers("resampling", "segment_batches", cuts),
                            rows.withColumn("segment", F.lit(0)).schema)
    counts = {r["segment"]: r["n"]
              for r in dealt.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    offsets, seen = [], 0
    for s in range(segments):
        offsets.append(seen)
        seen += counts.get(s, 0)
    merged = dealt.repartitionById(segments, F.col("segment")).sortWithinPartitions("segment", *KEY)
    out = merged.mapInArrow(on_workers("resampling", "rank_batches", offsets),
                            "doc_id long, n_features long, weight long, score long, rank long")
    return out, total


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT,
             seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_features, weight,
    score, rank (1 for the highest score; null where not drawn).  ``target``
    (text) gives the distribution.

    A null text has no words and no features; its weight is 0.  Texts under
    MIN_WORDS words are never drawn.  Equal scores rank by doc_id, a null (its
    Gumbel term is that of an empty id) last; rows alike in both rank by their
    number of features, then in any order.  Empty tables give empty tables; an
    empty target counts 0 in every bucket.  Very long texts are hashed in
    pieces.  Other columns are ignored."""
    base = docs.select("doc_id", no_null_text("text").cast("binary").alias("text"))
    gain = gains(bucket_counts(docs), bucket_counts(target))
    weighed = base.mapInArrow(on_workers("resampling", "weigh_batches", gain),
                              "doc_id long, n_words long, n_features long, weight long")
    runs = sorted_runs(weighed.withColumn("score", F.col("weight") + gumbel(seed)))
    order, total = ranked(runs.where(F.col("n_words") >= MIN_WORDS))
    drawn = F.when(F.col("rank") <= percent * total // 100, F.col("rank"))
    others = runs.where(F.col("n_words") < MIN_WORDS).select(
        "doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return order.withColumn("rank", drawn).unionAll(others)
