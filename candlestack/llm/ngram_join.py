"""N-gram Jaccard join by filtering under several global token orders.

Tokens are word shingles, hashed to 64 bits.  Two sets with Jaccard >= t
share a token within the first |x| - ceil(t |x|) + 1 tokens of both, whatever
global order the tokens are put in.  Three orders are used: two put rare
tokens first by two independent count sketches of the whole corpus, the third
is the order of the hashes.  Candidates share a prefix token under the first
order (enough of them for the overlap that the threshold needs); before a pair is verified, its
prefixes under the second and third order must intersect too.

Near copies do not become all pairs: texts with equal shingle sets are one
class, and in each group of classes that share a token, first the smallest
and the largest class are compared with all others.  Links found make
components, and only classes of a group that still lie in different
components are paired with each other, so no link between components is lost.
There, tokens that the same classes hold are one key, and the join on it drops
a pair whose sets differ in too much: each class carries a bitmap of its set,
in which every token flips one bit, and two bitmaps differ in no more bits
than the sets in tokens.  Verification is exact on the whole sets.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlestack.llm.common import (materialize, no_null_text, on_workers,
                                      on_workers_grouped, slices)
from candlestack.llm.components import components

WORDS = 5
THRESHOLD = 0.75
#: Counters of each of the two sketches: 2 ** SKETCH_BITS.
SKETCH_BITS = 22
SLICES = 64
#: Largest count that the orders tell apart: any order is right, a fine one is quick.
TOP_COUNT = 0xFFFF
#: A class is first compared with centres of its groups if it meets them in one
#: in STAR of the tokens that a link needs: a centre may lack some tokens that
#: the class shares with others.
STAR = 3
#: Bits of the filter by which a pass over the texts finds wanted documents,
#: set at three places for each; a Spark bitmap holds 2 ** 15 of them.
FILTER_BITS = 26
#: Bits of a class's bitmap, in 64-bit numbers: 2 ** MAP_BITS.
MAP_BITS = 10
MAP_LONGS = (1 << MAP_BITS) // 64
#: Bytes of text that are hashed at once, and rows whose sets are held at once.
PIECE_BYTES = 1 << 18
ROWS = 200

_MUL = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MUL[0]
    x = (x ^ (x >> np.uint64(27))) * _MUL[1]
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(texts: list, words: int = WORDS) -> list:
    """The ascending distinct shingle hashes (uint64) of each text (bytes)."""
    out: list = []
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE_BYTES):
            size += len(texts[end])
            end += 1
        out += _shingle_sets(texts[at:end], words)
        at = end
    return out


def words_of(texts: list) -> tuple:
    """(bytes, starts, ends, hashes) of the words of ``texts`` (bytes), which
    stand in one array with a line feed after each."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return data, starts, ends, np.zeros(0, np.uint64)
    # a word's hash: its bytes' numbers times powers of an odd base
    sizes = ends - starts
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    power = _powers(_BASE | 1, int(sizes.max()))
    terms = _BYTE[data[inside]] * power[place]
    return data, starts, ends, mix64(np.add.reduceat(terms, np.cumsum(sizes) - sizes)
                                     + sizes.astype(np.uint64))


def _shingle_sets(texts: list, words: int) -> list:
    none = np.zeros(0, np.uint64)
    _, starts, _, word = words_of(texts)
    if not len(starts):
        return [none for _ in texts]
    factor = _powers(0xD6E8FEB86659FD93, words + 1)
    n = len(word)
    rolled = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words if n >= words else 0):
        rolled += word[k:n - words + 1 + k] * factor[k]
    rolled = mix64(rolled)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, bounds)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            whole = (word[a:b] * factor[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mix64(np.array([whole], np.uint64)))
        else:
            sets.append(none)
    return sets


def set_class(tokens: np.ndarray) -> int:
    """64-bit name of a set of tokens."""
    with np.errstate(over="ignore"):
        total = mix64(tokens + np.uint64(_BASE)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix64(np.array([total], np.uint64)).astype(np.int64)[0])


def prefix_length(n: int, t: float) -> int:
    return n - math.ceil(round(t * n, 9)) + 1


def _slot(tokens: np.ndarray, sketch: int, bits: int) -> np.ndarray:
    return ((tokens >> np.uint64(0 if sketch else 32)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def in_order(tokens: np.ndarray, ranks: list, order: int) -> np.ndarray:
    """The tokens in a global order: by count, then by hash.  The count of the
    first order is the lower one of both sketches, which is nearer to the true
    one; the second order has the second sketch alone."""
    if ranks[0] is None:
        return tokens
    bits = int(len(ranks[0])).bit_length() - 1
    count = ranks[1][_slot(tokens, 1, bits)]
    if order == 0:
        count = np.minimum(count, ranks[0][_slot(tokens, 0, bits)])
    return tokens[np.lexsort((mix64(tokens + np.uint64(order + 1)), count))]


def pack_counts(counts: np.ndarray) -> bytes:
    """Counters as compressed planes of their low to high bytes: most are small."""
    planes = counts.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zlib.compress(planes.tobytes(), 6)


def unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def bitmaps(sets: list) -> np.ndarray:
    """One row of MAP_LONGS numbers for each set: its tokens flip the bits that
    their upper MAP_BITS bits name."""
    size = 1 << MAP_BITS
    if not sets:
        return np.zeros((0, MAP_LONGS), np.int64)
    slot = (np.concatenate(sets) >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    slot += np.repeat(np.arange(len(sets)) * size, [len(x) for x in sets])
    odd = np.bincount(slot, minlength=len(sets) * size).reshape(-1, size) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view("<i8")


def pack_set(tokens: np.ndarray, second: np.ndarray) -> tuple:
    """An ascending set as the upper six bytes of its hashes, and which of them
    are in ``second`` as bits."""
    upper = tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return upper.tobytes(), np.packbits(np.isin(tokens, second, assume_unique=True)).tobytes()


def unpack_set(data: bytes, bits: bytes) -> tuple:
    """The set (ascending) and its part in the second prefix (ascending)."""
    upper = np.frombuffer(data, np.uint8).reshape(-1, 6)
    whole = np.zeros((len(upper), 8), np.uint8)
    whole[:, :6] = upper
    tokens = whole.view(">u8").ravel().astype(np.uint64)
    inside = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(tokens)).astype(bool)
    return tokens, tokens[inside]


# --- passes over the texts ---------------------------------------------------

def survey_batches(batches: Iterator, words: int, bits: int) -> Iterator:
    """(doc_id, n, cls, bitmap) of each document, and at the end the task's
    counts of both sketches as slices."""
    import pyarrow as pa

    names = ["doc_id", "n", "cls", "bitmap", "slice", "counts"]
    counts = [np.zeros(1 << bits, np.uint32) for _ in range(2)]
    seen: set = set()
    for batch in slices(batches, ROWS):
        sets = shingle_sets(batch["text"].to_pylist(), words)
        n = [len(s) for s in sets]
        cls = [set_class(s) if len(s) else None for s in sets]
        new = {c: s for s, c in zip(sets, cls) if c is not None and c not in seen}
        seen.update(new)  # copies in a task count once
        if new:
            tokens = np.concatenate(list(new.values()))
            for k in range(2):
                slot, times = np.unique(_slot(tokens, k, bits), return_counts=True)
                counts[k][slot] += times.astype(np.uint32)
        marks = pa.ListArray.from_arrays(
            pa.array(np.arange(len(n) + 1) * MAP_LONGS, pa.int32()),
            pa.array(bitmaps(sets).ravel(), pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n, pa.int64()), pa.array(cls, pa.int64()), marks,
             pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names)
    if seen:
        parts = [pack_counts(p) for k in range(2)
                 for p in np.array_split(counts[k], SLICES)]
        m = len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
             pa.nulls(m, pa.list_(pa.int64())), pa.array(range(m), pa.int32()), pa.array(parts, pa.binary())], names)


def sum_slices(table):
    """The sum of one slice over all tasks; counts from TOP_COUNT on are alike."""
    import pyarrow as pa

    total = sum(unpack_counts(b.as_py()).astype(np.uint64) for b in table["counts"])
    total = np.minimum(total, np.uint64(TOP_COUNT)).astype("<u2").tobytes()
    return pa.table({"slice": pa.array([table["slice"][0].as_py()], pa.int32()),
                     "counts": pa.array([total], pa.binary())})


def token_batches(batches: Iterator, words: int, t: float, ranks) -> Iterator:
    """Prefix tokens under the first order, with the size n of their set:
    (token, cls, n).  A class comes once from each task.  Tokens go out as the
    upper 48 bits: two that fall together only add candidates."""
    import pyarrow as pa

    seen: set = set()
    for batch in slices(batches, ROWS):
        token, cls, n = [], [], []
        for s in shingle_sets(batch["text"].to_pylist(), words):
            if not len(s) or (c := set_class(s)) in seen:
                continue
            seen.add(c)
            p = prefix_length(len(s), t)
            token.append((in_order(s, ranks.value, 0)[:p] >> np.uint64(16)).astype(np.int64))
            cls.append(np.full(p, c, np.int64))
            n.append(np.full(p, len(s), np.int64))
        arrays = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (token, cls, n)]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays],
                                         ["token", "cls", "n"])


def set_batches(batches: Iterator, words: int, t: float, ranks, wanted) -> Iterator:
    """(cls, tokens, second) of the documents whose places p0 to p2 are set in
    the filter: the set in the order of the hashes (the third order) and its
    prefix under the second order, packed."""
    import pyarrow as pa

    bits = wanted.value
    for batch in slices(batches, ROWS):
        hit = np.ones(batch.num_rows, bool)
        for name in ("p0", "p1", "p2"):
            p = batch[name].to_numpy()
            hit &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        texts = batch["text"].filter(pa.array(hit)).to_pylist()
        sets = [s for s in shingle_sets(texts, words) if len(s)]
        packed = [pack_set(s, in_order(s, ranks.value, 1)[:prefix_length(len(s), t)])
                  for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array([set_class(s) for s in sets], pa.int64()),
             pa.array([p[0] for p in packed], pa.binary()),
             pa.array([p[1] for p in packed], pa.binary())], ["cls", "tokens", "second"])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    return len(np.intersect1d(x, y, assume_unique=True))


def verify_batches(batches: Iterator, t: float) -> Iterator:
    """Rows (a, b, side, tokens, second), sorted by pair and side, to the
    pairs that pass the second and the third order and the exact test."""
    import pyarrow as pa

    left = None
    for batch in slices(batches):
        a, b = [], []
        for x, y, side, tokens, second in zip(*(batch[c].to_pylist() for c in (
                "a", "b", "side", "tokens", "second"))):
            if side == 0:
                left = (x, y, *unpack_set(tokens, second))
            elif left is not None and left[:2] == (x, y):
                if _linked(*left[2:], *unpack_set(tokens, second), t):
                    a.append(x)
                    b.append(y)
                left = None  # once for each pair
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                         ["a", "b"])


def _linked(x: np.ndarray, second_x: np.ndarray, y: np.ndarray, second_y: np.ndarray,
            t: float) -> bool:
    if not _common(second_x, second_y):
        return False
    if not _common(x[:prefix_length(len(x), t)], y[:prefix_length(len(y), t)]):
        return False
    both = _common(x, y)
    return both >= t * (len(x) + len(y) - both) - 1e-9


# --- the join ------------------------------------------------------------------

def _verified(pairs: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """``pairs`` that link.  ``sets`` meets the pairs on the class, then both
    sides of a pair meet, so a set moves once, and once for each of its pairs."""
    sides = pairs.select("a", "b", F.explode(F.array(
        F.struct(F.col("a").alias("cls"), F.lit(0).alias("side")),
        F.struct(F.col("b").alias("cls"), F.lit(1).alias("side")))).alias("s")).select(
        "a", "b", "s.*")
    return (sets.join(sides.hint("merge"), "cls").select("a", "b", "side", "tokens", "second")
            .repartition("a", "b").sortWithinPartitions("a", "b", "side")
            .mapInArrow(on_workers("ngram_join", "verify_batches", t), "a long, b long"))


def link_classes(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                 sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n, cls, component (names of the row's class and of the smallest
    class reachable, null without words) for every row of
    ``docs``, by the rules of ``link_components``."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", no_null_text("text").cast("binary").alias("text"))
    survey = materialize(texts.mapInArrow(
        on_workers("ngram_join", "survey_batches", words, sketch_bits),
        "doc_id long, n long, cls long, bitmap array<long>, slice int, counts binary"), "survey")
    classes = survey.where("slice is null").select("doc_id", "n", "cls")
    # both sketches: 2 ** (sketch_bits + 1) numbers, whatever the corpus, read into
    # their places a part at a time
    sums = materialize(survey.where("slice is not null").select("slice", "counts").groupBy("slice")
                       .applyInArrow(on_workers_grouped("ngram_join", "sum_slices"),
                                     "slice int, counts binary"), "sketches")
    ranks = [np.zeros(1 << sketch_bits, "<u2") for _ in range(2)]
    places = [p for k in range(2) for p in np.array_split(ranks[k], SLICES)]
    for r in sums.toLocalIterator():
        places[r.slice][:] = np.frombuffer(r.counts, "<u2")
    shared = spark.sparkContext.broadcast(ranks)
    sent = [shared]  # given back when the last step that reads them is written
    del ranks, places

    tokens = texts.select("text").mapInArrow(
        on_workers("ngram_join", "token_batches", words, threshold, shared),
        "token long, cls long, n long")
    group = Window.partitionBy("token")
    grouped = materialize(
        tokens.withColumn("lo", F.min("cls").over(group))
        .withColumn("hi", F.max("cls").over(group)).where("lo <> hi")
        .select("token", "cls", "n").distinct()
        .withColumn("size", F.count(F.lit(1)).over(group)), "grouped")

    # the prefixes share c tokens, and the rest of one of the two sets can add
    # no more than its length, ceil(t n) - 1; together the overlap must reach
    # t / (1 + t) (n + m)
    def enough(c, x, y):
        rest_of = F.greatest(F.ceil(F.lit(threshold) * x - 1e-9),
                             F.ceil(F.lit(threshold) * y - 1e-9)) - 1
        need = F.lit(threshold / (1 + threshold)) * (x + y) - 1e-6
        return ((F.least(x, y) >= F.lit(threshold) * F.greatest(x, y) - 1e-9)
                & (c + rest_of >= need))

    # a group's centre is the class whose prefix tokens are shared most, on
    # average: in a family of near copies the one with the fewest own edits
    # (a class has no more rows than its prefix; tokens and classes move once)
    prefix = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    weighed = grouped.select("token", "cls", "n", (F.sum("size").over(
        Window.partitionBy("cls")) / prefix).alias("weight"))
    top = F.max(F.struct("weight", F.col("cls").alias("centre"), F.col("n").alias("m"))).over(group)
    near = (weighed.withColumn("top", top)
            .select("token", "cls", "n", "top.centre", "top.m", F.col("top.weight").alias("of"))
            .where("cls <> centre")
            .groupBy("cls", "centre").agg(
                F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("m").alias("m"),
                F.first("of").alias("of"))
            .where(enough(STAR * F.col("c"), F.col("n"), F.col("m"))))
    chosen = near.groupBy("cls").agg(F.max_by("centre", F.struct("c", "centre")).alias("one"),
                                     F.max_by("centre", F.struct("of", "centre")).alias("two"))
    first_pairs = materialize(
        chosen.select("cls", F.explode(F.array("one", "two")).alias("with")).select(
            F.least("cls", "with").alias("a"), F.greatest("cls", "with").alias("b")).distinct(),
        "pairs")

    def sets_of(pairs: DataFrame) -> DataFrame:
        """The sets of all classes in ``pairs``: one pass over the texts, which
        a filter of fixed size over the ids of one holder of each class
        narrows to little more than those; no text is shuffled."""
        needed = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        holders = (classes.where("cls is not null").groupBy("cls")
                   .agg(F.min("doc_id").alias("doc_id")).join(needed, "cls", "left_semi"))
        places = [F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(1 << FILTER_BITS)).cast("long")
                  for i in range(3)]
        # at most 2 ** FILTER_BITS bits
        maps = (holders.select(F.explode(F.array(*places)).alias("p"))
                .groupBy(F.shiftright("p", 15).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND((1 << 15) - 1)).alias("bits"))
                .collect())
        bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for r in maps:
            bits[r.bucket << 12:(r.bucket + 1) << 12] = np.frombuffer(bytes(r.bits), np.uint8)
        wanted = spark.sparkContext.broadcast(bits)
        sent.append(wanted)
        return texts.select("text", *[p.alias(f"p{i}") for i, p in enumerate(places)]).mapInArrow(
            on_workers("ngram_join", "set_batches", words, threshold, shared, wanted),
            "cls long, tokens binary, second binary")

    first = materialize(_verified(first_pairs, sets_of(first_pairs), threshold), "links")
    member = materialize(components(first), "members")

    # what is left: classes of one group that lie in different components.  All
    # tokens of the same classes get one key: a hash of those (lists that fall
    # together only add candidates)
    left = (grouped.join(member.withColumnRenamed("node", "cls"), "cls", "left")
            .withColumn("component", F.coalesce("component", "cls")))
    left = (left.withColumn("c0", F.min("component").over(group))
            .withColumn("c1", F.max("component").over(group))
            .withColumn("key", F.bit_xor(F.xxhash64("cls")).over(group)).where("c0 <> c1")
            .groupBy("key", "cls").agg(F.first("component").alias("component"),
                                       F.first("n").alias("n"), F.count(F.lit(1)).alias("w")))
    left = materialize(left, "left")
    held_by = (left.groupBy("cls").agg(F.sum("w").alias("held"))
               .join(survey.where("cls is not null").select("cls", "bitmap"), "cls")
               .groupBy("cls").agg(F.first("held").alias("held"), F.first("bitmap").alias("map")))
    # a key's home is the component with most of its classes, which are not
    # compared with each other
    home = (left.groupBy("key", "component").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("key").agg(F.max_by("component", F.struct("k", "component")).alias("home")))
    posts = materialize(
        left.join(home, "key").join(held_by, "cls").select(
            "key", "cls", "component", "n", "w", "held", "home",
            *[F.col("map")[i].alias(f"m{i}") for i in range(MAP_LONGS)]), "posts")

    def side(name: str) -> DataFrame:
        return posts.select("key", *[F.col(c).alias(f"{c}_{name}")
                                     for c in posts.columns if c not in ("key", "home")], "home")

    one, two = side("u").where("component_u <> home").drop("home"), side("v")
    t = F.lit(threshold)
    x, y = F.col("n_u"), F.col("n_v")
    differ = sum((F.bit_count(F.col(f"m{i}_u").bitwiseXOR(F.col(f"m{i}_v")))
                  for i in range(1, MAP_LONGS)),
                 F.bit_count(F.col("m0_u").bitwiseXOR(F.col("m0_v"))))
    rest = materialize(
        one.join(two, "key").where(
            (F.col("component_u") != F.col("component_v"))
            & ((F.col("component_v") == F.col("home")) | (F.col("cls_u") < F.col("cls_v")))
            & enough(F.least("held_u", "held_v"), x, y)
            # sets that link differ in (1 - t) / (1 + t) (n + m) tokens at most
            & (differ <= (1 - t) / (1 + t) * (x + y) + 1e-6))
        .groupBy(F.least("cls_u", "cls_v").alias("a"), F.greatest("cls_u", "cls_v").alias("b"))
        .agg(F.sum(F.greatest("w_u", "w_v")).alias("c"), F.first(x).alias("x"),
             F.first(y).alias("y"))
        .where(enough(F.col("c"), F.col("x"), F.col("y"))).select("a", "b")
        .join(first_pairs, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        second = _verified(rest, sets_of(rest), threshold)
        member = materialize(components(
            member.select(F.col("node").alias("a"), F.col("component").alias("b"))
            .unionAll(second)), "members")
    for held in sent:
        held.destroy()

    return (classes.join(member.withColumnRenamed("node", "cls"), "cls", "left")
            .withColumn("component", F.coalesce("component", "cls")))


def link_components(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                    sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Documents link when the Jaccard coefficient of their distinct ``words``-word
    shingles is at least ``threshold``; component_id is the smallest doc_id
    reachable.  A text with fewer words is one shingle; a null or empty text,
    or one of white space, has none and links with nothing (component_id is
    its doc_id).  Repeated rows link with each other; a null doc_id takes part
    but never names a component unless all its members are null.  Words are
    runs of anything but ASCII white space, A-Z in lower case.  Very long
    texts are read whole; an empty table gives an empty table; other columns
    are ignored.  Shingles and sets are told apart by 64-bit hashes; where two sets
    are compared, by the upper 48 bits of those of their shingles."""
    named = link_classes(docs, words, threshold, sketch_bits)
    least = (named.where("component is not null").groupBy("component")
             .agg(F.min("doc_id").alias("least")))
    return (named.join(least, "component", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("least", "doc_id").alias("component_id")))
