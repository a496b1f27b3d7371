"""Spelling variant grouping by PartEnum signatures.

A word is read as the multiset of its letters, and that as a binary vector
with one place for each (letter, how many of it before).  One letter inserted
or deleted moves the vector by one, one letter replaced by two.  The places
are dealt to PARTS parts, and the signatures of a word are the hashes of all
ways to leave out as many parts as may differ: two words within the distance
share a signature.  The length goes into the signature (words that differ by
a letter more or less meet under the shorter length), and so does the half of
the word that one edit leaves as it is, which keeps the groups of a signature
small.  Signatures are equi-joined and every pair is verified.

Counting comes first: runs are counted in each task before they are shuffled.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestack.llm.common import materialize, no_null_text, on_workers
from candlestack.llm.ngram_join import mix64

MIN_LETTERS = 7
MIN_COUNT = 2
#: A run loses a letter if its hash with the doc_id is a multiple of this.
SLIP = 31
#: A form is so many times as frequent as the words it stands for.
RATIO = 10
PARTS = 4
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 200_000

_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % MIN_LETTERS)


def run_counts(docs: Iterator) -> Iterator[Counter]:
    """Words and their counts of (doc_id, text)s, in counters of bounded size.

    Latin-1 has a byte for every letter that counts; other characters become a
    question mark, which does not, and lower() on bytes lowers A-Z only."""
    counts: Counter = Counter()
    for doc, text in docs:
        runs = Counter(_RUN.findall(text.encode("latin-1", "replace").lower()))
        start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
        for run, n in runs.items():
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
            if h % SLIP == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < MIN_LETTERS:
                    continue
            counts[run] += n
        if len(counts) >= HELD_WORDS:
            yield counts
            counts = Counter()
    yield counts


def count_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa

    rows = ((doc.as_py(), text.as_py()) for batch in batches
            for doc, text in zip(batch["doc_id"], batch["text"]))
    for counts in run_counts(rows):
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of ``docs`` that occur MIN_COUNT times."""
    return (docs.select("doc_id", no_null_text("text").alias("text"))
            .mapInArrow(on_workers("spelling", "count_batches"), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))


# --- signatures -------------------------------------------------------------------------

def part_hashes(words: list, parts: int = PARTS) -> np.ndarray:
    """A row for each word (Latin-1 bytes): hash of its places in each part."""
    sizes = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    of = np.repeat(np.arange(len(words)), sizes)
    order = np.lexsort((letters, of))
    letters, of = letters[order], of[order]
    fresh = np.ones(len(letters), bool)
    fresh[1:] = (letters[1:] != letters[:-1]) | (of[1:] != of[:-1])
    at = np.arange(len(letters))
    before = at - np.maximum.accumulate(np.where(fresh, at, 0))
    place = mix64((letters << 32 | before).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(words), parts), np.uint64)
    np.add.at(out, (of, ((place >> np.uint64(7)) % np.uint64(parts)).astype(np.int64)), mix64(place))
    return out


def signature_rows(words: list, parts: int = PARTS) -> tuple:
    """(word number, longer, signature): ``longer`` rows meet rows that are not, whose
    words have a letter less; the others meet each other too."""
    own = part_hashes(words, parts)
    sizes = np.array([len(w) for w in words], np.uint64)
    rows = np.arange(len(words))
    halves: dict = {}

    def half(longer: int, tail: int) -> np.ndarray:
        """Hash of the half that the edit spares: the head of n // 2 letters, or
        what stands behind it (in the longer word, behind the letter after it)."""
        if (longer, tail) not in halves:
            out = np.empty(len(words), np.uint64)
            for i, w in enumerate(words):
                h = (len(w) - longer) // 2
                kept = w[h + longer:] if tail else w[:h]
                out[i] = zlib.crc32(kept) | zlib.adler32(kept) << 32
            halves[longer, tail] = mix64(out + np.uint64(tail))
        return halves[longer, tail]

    out = []
    # replaced: same length, two places differ; inserted or deleted: one
    for kind, (left_out, longer) in enumerate(((2, 0), (1, 0), (1, 1))):
        for gone in itertools.combinations(range(parts), left_out):
            kept = [p for p in range(parts) if p not in gone]
            name = np.uint64(min(kind, 1) << 32 | sum(1 << p for p in gone))
            base = mix64(own[:, kept].sum(1, dtype=np.uint64) + mix64(
                (sizes - np.uint64(longer)) << np.uint64(40) | name))
            for tail in (0, 1):
                out.append((rows, np.full(len(words), longer), mix64(base ^ half(longer, tail))))
    return tuple(np.concatenate(c) for c in zip(*out))


def signature_batches(batches: Iterator, parts: int) -> Iterator:
    """(word, n) to (signature, longer, word, n)."""
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 5_000):
            piece = batch.slice(at, 5_000)
            words = [w.encode("latin-1") for w in piece["word"].to_pylist()]
            rows, longer, signature = signature_rows(words, parts)
            piece = piece.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signature.view(np.int64)), pa.array(longer == 1), piece["word"],
                 piece["n"]], ["signature", "longer", "word", "n"])


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of ``words`` (word, n; distinct, of letters up
    to U+00FF) that differ by exactly one letter, once each."""
    rows = words.select("word", "n").mapInArrow(
        on_workers("spelling", "signature_batches", parts),
        "signature long, longer boolean, word string, n long")
    # both sides read the same rows, so the signatures are shuffled once; the
    # condition names both sides throughout, or it would be pushed into one
    rows = rows.withColumn("longer", F.col("longer").cast("int"))
    a = rows.toDF("signature", "a_longer", "a", "n_a")
    b = rows.toDF("signature", "b_longer", "b", "n_b")
    meet = ((F.col("a_longer") < F.col("b_longer"))
            | ((F.col("a_longer") + F.col("b_longer") == 0) & (F.col("a") < F.col("b"))))
    # 28 rows a word: their size is not seen by the planner, which could broadcast them
    return (a.join(b.hint("merge"), "signature")
            .where(meet & (F.levenshtein("a", "b", 1) == 1))
            .select("a", "n_a", "b", "n_b").distinct())


def variants(docs: DataFrame, parts: int = PARTS) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, form, root, n, n_near,
    form_n.

    Words are runs of letters up to U+00FF, A-Z lowered, of MIN_LETTERS letters
    and MIN_COUNT occurrences; one run in SLIP, chosen by its hash with the
    doc_id (a null is empty), loses a letter first.  ``form`` is the near word
    (one letter inserted, deleted or replaced) of largest n, ties to the
    smaller, if it is RATIO times as frequent; ``root`` the last of the chain of
    forms.  Repeated rows count each time; a null text has no words; an empty
    table gives an empty table; other columns are ignored."""
    words = materialize(word_counts(docs), "words")
    pairs = materialize(near_pairs(words, parts), "near")
    both = pairs.unionAll(pairs.select("b", "n_b", "a", "n_a")).toDF("word", "n", "near", "near_n")
    best = (both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"),
                (-F.col("best.col1")).alias("near_n")))
    is_form = F.col("near_n") >= RATIO * F.col("n")
    found = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "forms")
    # a chain grows RATIO-fold by step, so its length is bounded by the largest n
    top = found.agg(F.max("n")).first()[0] or MIN_COUNT
    longest = int(math.log(top / MIN_COUNT, RATIO)) + 1
    up = found.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(1, longest).bit_length()):  # each step doubles the reach
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        up = materialize(up.join(nxt, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")), "roots")
    return (found.join(up, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                    "form_n"))
