"""Substring dedup by line hashing.

Lines are the units.  A line is normalised (ASCII lower case, white space
collapsed) and hashed to 128 bits; digests are grouped globally with partial
aggregates and the earliest occurrence, by (doc_id, offset), is kept.  All
later occurrences are removed from their documents, and their offsets in the
original text are returned.

Units carry no text through the shuffle: digest, document key and offsets.
A digest that very many lines share is one row on the grouped side, joined to
its occurrences by a plain equi-join that Spark may split.

``dedup_passages`` adds passages that start or end inside a line.  Its further
units are runs of PASSAGE_WORDS words, across line breaks; of each PASSAGE_STEP
runs that follow each other the one with the least hash is taken, so copies of
a passage take the same ones wherever they stand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlestack.llm.common import no_null_text, on_workers, slices, text_key
from candlestack.llm.ngram_join import PIECE_BYTES, mix64, words_of

#: Lines with fewer words are never removed (headings, lone marks, numbers).
MIN_WORDS = 5
#: A shared passage of PASSAGE_WORDS + PASSAGE_STEP - 1 words or more is always
#: found; fewer than PASSAGE_STEP words may stay at either end of it.
PASSAGE_WORDS = 16
PASSAGE_STEP = 10
#: Runs that a task compares with each other before they are shuffled.
CHUNK_UNITS = 500_000


def unit_batches(batches: Iterator, min_words: int) -> Iterator:
    """(doc_id, text_key, text) to one row per line of ``min_words`` words or more."""
    import pyarrow as pa

    for batch in slices(batches):
        ids, keys, digests, starts, ends = [], [], [], [], []
        for doc, key, text in zip(batch["doc_id"].to_pylist(), batch["text_key"].to_pylist(),
                                  batch["text"].to_pylist()):
            at = 0
            for line in text.split("\n"):
                words = line.encode().lower().split()
                if len(words) >= min_words:
                    ids.append(doc)
                    keys.append(key)
                    digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    starts.append(at)
                    ends.append(at + len(line))
                at += len(line) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.string()),
             pa.array(digests, pa.binary()), pa.array(starts, pa.int64()),
             pa.array(ends, pa.int64())], ["doc_id", "text_key", "digest", "begin", "end"])


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, begin, end) of every line occurrence that is not the
    earliest of its digest.  Rows of one doc_id count as one document when
    occurrences are ranked; a null doc_id ranks last."""
    units = docs.mapInArrow(on_workers("line_dedup", "unit_batches", min_words),
                            "doc_id long, text_key string, digest binary, begin long, end long")
    first = (units.groupBy("digest")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "begin"))
                  .alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("digest", "first"))
    return (units.join(first, "digest")
            .where(~(F.col("first.doc_id").eqNullSafe(F.col("doc_id"))
                     & (F.col("first.begin") == F.col("begin"))))
            .select("doc_id", "text_key", "begin", "end"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_lines, n_removed,
    ``removed`` (array of struct(begin, end): code points in the original
    text, end exclusive, ascending), ``text`` (what stays; a removed line goes
    with its line break).

    A null text counts as empty and comes back empty; an empty text is one
    line that stays.  Repeated rows (same doc_id, same text) all keep the
    first occurrence.  Very long texts are walked line by line.  An empty
    table gives an empty table; other columns of ``docs`` are ignored."""
    base = docs.select("doc_id", no_null_text("text").alias("text"))
    keyed = base.withColumn("text_key", text_key(F.col("text")))
    gone = (repeated_lines(keyed, min_words)
            .groupBy("doc_id", "text_key")
            .agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("removed")))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "removed")
    out = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.col("text_key") == F.col("_key")), "left")
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    out = out.withColumn("removed", F.coalesce("removed", none))
    return out.mapInArrow(on_workers("line_dedup", "kept_batches"),
                          "doc_id long, n_lines long, n_removed long,"
                          " removed array<struct<begin:bigint,end:bigint>>, text string")


def kept_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in slices(batches):
        texts, lines = [], []
        for text, gone in zip(batch["text"].to_pylist(), batch["removed"].to_pylist()):
            cut = {g["begin"] for g in gone}
            at, kept, n = 0, [], 0
            for line in text.split("\n"):
                if at not in cut:
                    kept.append(line)
                at += len(line) + 1
                n += 1
            texts.append("\n".join(kept))
            lines.append(n)
        removed = batch["removed"]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(lines, pa.int64()),
             pa.array([len(g) for g in removed.to_pylist()], pa.int64()), removed,
             pa.array(texts, pa.string())],
            ["doc_id", "n_lines", "n_removed", "removed", "text"])


# --- passages -------------------------------------------------------------------

def passage_units(texts: list, words: int, step: int) -> tuple:
    """(text number, digest, begin, end) arrays of the runs taken from ``texts``
    (bytes): digests as two 64-bit numbers a row, offsets in code points."""
    data, starts, ends, word = words_of(texts)
    n = len(word) - words + 1
    if n < step:
        none = np.zeros(0, np.int64)
        return none, np.zeros((0, 2), np.uint64), none, none
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    of = np.searchsorted(bounds, starts, side="right") - 1
    # a second, independent hash of each word for the other 64 bits
    halves = []
    for base in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93):
        one, factor = mix64(word ^ np.uint64(base)), np.uint64(1)
        run = np.zeros(n, np.uint64)
        for k in range(words):
            run += one[k:n + k] * factor
            factor = np.uint64(int(factor) * base & 0xFFFFFFFFFFFFFFFF)
        halves.append(mix64(run))
    least = np.lib.stride_tricks.sliding_window_view(halves[0], step).argmin(1)
    at = np.arange(len(least)) + least
    # only steps that lie in one text, so a text's units are its own
    at = np.unique(at[of[:len(least)] == of[words + step - 2:]])
    lead = np.cumsum((data & 0xC0) != 0x80)
    first = np.concatenate([[0], lead])[bounds[of[at]]]
    begin = lead[starts[at]] - 1 - first
    end = lead[ends[at + words - 1] - 1] - first
    return of[at], np.stack([h[at] for h in halves], 1), begin, end


def passage_batches(batches: Iterator, words: int, step: int) -> Iterator:
    """(doc_id, key, text) to one row per run taken.  Of each CHUNK_UNITS runs or
    so, those that repeat an earlier one of them are marked ``dup``, under a
    name of their own: a passage in very many documents stays a small group."""
    import pyarrow as pa

    parts, held = [], 0

    def chunk():
        rows = [np.concatenate(c) for c in zip(*parts)]
        null, doc, key, one, two, begin, end = rows
        order = np.lexsort((begin, key, doc, null, two, one))
        null, doc, key, one, two, begin, end = (c[order] for c in rows)
        same = np.zeros(len(one), bool)
        same[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
        again = same.copy()  # rows that stand in the table more than once
        here = [null, doc, key, begin]
        again[1:] &= np.all([c[1:] == c[:-1] for c in here], 0)
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(one))))
        own = np.all([c == c[head] for c in here[:3]], 0) & (begin < end[head])
        dup = same & ~own
        own_name = mix64(key.astype(np.uint64) * np.uint64(31) + begin.astype(np.uint64))
        one = np.where(dup, own_name, one)
        place = begin.astype(np.int64) << 32 | (end - begin).astype(np.int64)
        more = two.astype(np.int64) << 1 | dup
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, mask=null), pa.array(key), pa.array(one.view(np.int64)),
             pa.array(place), pa.array(more)],
            ["doc_id", "key", "one", "place", "more"]).filter(pa.array(~again))

    for batch in slices(batches):
        texts = [t.encode() for t in batch["text"].to_pylist()]
        null = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
        doc = batch["doc_id"].fill_null(0).to_numpy()
        key = batch["key"].to_numpy()
        at = 0
        while at < len(texts):
            size, stop = 0, at
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= PIECE_BYTES):
                size += len(texts[stop])
                stop += 1
            of, digest, begin, end = passage_units(texts[at:stop], words, step)
            of = of + at
            parts.append((null[of], doc[of], key[of], digest[:, 0],
                          (digest[:, 1] >> np.uint64(32)).astype(np.uint32), begin, end))
            held += len(of)
            if held >= CHUNK_UNITS:
                yield chunk()
                parts, held = [], 0
            at = stop
    if held:
        yield chunk()


def repeated_passages(docs: DataFrame, words: int = PASSAGE_WORDS,
                      step: int = PASSAGE_STEP) -> DataFrame:
    """(doc_id, key, begin, end) of every run taken that is not the earliest of
    its digest, by (doc_id, key, offset), nor overlaps it."""
    units = docs.select("doc_id", "key", "text").mapInArrow(
        on_workers("line_dedup", "passage_batches", words, step),
        "doc_id long, key long, one long, place long, more long")
    # place: begin, then length in 32 bits; more: the digest's rest, then dup
    first = F.min(F.struct((F.col("more") % 2).alias("dup"), F.col("doc_id").isNull().alias("last"),
                           "doc_id", "key", "place", "more")).over(Window.partitionBy("one"))
    begin, length = F.shiftright("place", 32), F.col("place").bitwiseAND((1 << 32) - 1)
    top = (F.shiftright("first.place", 32)
           + F.col("first.place").bitwiseAND((1 << 32) - 1))
    return (units.withColumn("first", first)
            .where((F.col("more") % 2 == 1) | ((F.col("first.more") == F.col("more")) & ~(
                F.col("first.doc_id").eqNullSafe(F.col("doc_id"))
                & (F.col("first.key") == F.col("key")) & (begin < top))))
            .select("doc_id", "key", begin.cast("int").alias("begin"),
                    (begin + length).cast("int").alias("end")))


def dedup_passages(docs: DataFrame, min_words: int = MIN_WORDS, words: int = PASSAGE_WORDS,
                   step: int = PASSAGE_STEP) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_removed, ``removed``
    (array of struct(begin, end): code points in the original text, end
    exclusive, ascending, never overlapping), ``text`` (what stays).

    Removed are the repeated lines of ``dedup_lines`` and, wherever they stand,
    repeated passages: all of words + step - 1 words or more but for fewer than
    ``step`` words at either end, shorter ones from ``words`` words where the
    same runs are taken.  Units that touch or overlap are one range; a range
    that takes a line whole takes its line break.  Nulls, repeated rows and
    empty tables as in ``dedup_lines``."""
    base = docs.select("doc_id", no_null_text("text").alias("text"))
    short = F.conv(F.substring("text_key", 1, 15), 16, 10).cast("long")  # of one doc_id
    keyed = base.withColumn("text_key", text_key(F.col("text"))).withColumn("key", short)
    lines = repeated_lines(keyed, min_words).select(
        "doc_id", short.alias("key"), F.col("begin").cast("int"), F.col("end").cast("int"))
    gone = (lines.unionAll(repeated_passages(keyed, words, step))
            .groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
            .agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("removed")))
    out = keyed.select("doc_id", "key", "text").join(
        gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return out.select("doc_id", "text", "removed").mapInArrow(
        on_workers("line_dedup", "cut_batches"),
        "doc_id long, n_removed long, removed array<struct<begin:bigint,end:bigint>>,"
        " text string")


def cut_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa

    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches):
        texts, ranges = [], []
        for text, gone in zip(batch["text"].to_pylist(), batch["removed"].to_pylist()):
            merged: list = []
            for g in gone or ():
                if merged and g["begin"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], g["end"])
                else:
                    merged.append(dict(g))
            at, kept = 0, []
            for g in merged:
                kept.append(text[at:g["begin"]])
                at = g["end"]
                starts = g["begin"] == 0 or text[g["begin"] - 1] == "\n"
                if starts and text[at:at + 1] == "\n":
                    at += 1
            texts.append("".join([*kept, text[at:]]))
            ranges.append(merged)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array([len(r) for r in ranges], pa.int64()),
             pa.array(ranges, span), pa.array(texts, pa.string())],
            ["doc_id", "n_removed", "removed", "text"])
