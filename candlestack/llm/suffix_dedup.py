"""Substring dedup with a family of suffix arrays of geometric sizes.

A byte goes if a SPAN-byte string that covers it also starts in a document
with a smaller doc_id.  Suffixes are taken at content-defined places: the
anchor of a string is the GRAM-byte run in it with the least hash, so equal
strings have equal anchors, and a *suffix* stands for the consecutive starts
(at most SPAN - GRAM + 1) that share an anchor, with the bytes they cover.

1. Texts are packed into shards, written once.
2. Every shard sends the hashes of its anchors, four bytes each, to the range
   that owns them, and learns which stand in another document too.  Suffixes
   of other anchors cannot match and are never sent.
3. The rest go to their ranges.  Within a range they come in batches; the
   starts of a batch are put in the order of their SPAN-byte prefixes (by a
   64-bit hash: any order of prefixes finds the same equal neighbours), which
   is the batch's suffix array.  It is merge-scanned with every level of the
   family for equal prefixes; the larger document loses them.  What stays
   becomes a level, and levels of equal size merge into one of twice the size,
   so n starts are merged log(n / batch) times.
4. Lost starts return to their shards, where the bytes are cut.

A prefix is kept once, for its least document, so a passage in a third of all
documents is one entry of a level; a shard sends equal suffixes once, for its
least document.  Two prefixes are equal if their anchors belong to one range and
a 64-bit hash of all their bytes is equal: chance makes about one unequal pair
equal in 100 TB.

Texts are never shuffled: the shards are a bucketed table, and what a shard
learns or loses is joined to its bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestack.llm.common import no_null_text, on_workers, scratch_path
from candlestack.llm.ngram_join import _powers, mix64

#: Length of the strings that count, and of the runs that anchor them, in bytes.
SPAN = 50
GRAM = 20
#: Text in a shard and in a range (documents are never split between shards).
SHARD_BYTES = 8 << 20
RANGE_BYTES = 8 << 20
#: Starts that are hashed at once, and starts of a batch of the index family.
PIECE = 1 << 17
BATCH = 1 << 19
#: Bytes of a range's row from which they are compressed.
PACK_BYTES = 1 << 10

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LAST = np.iinfo(np.int64).max
#: Low bits of an ordering key hold the place, so the first of equal runs wins.
_PLACE = np.uint64((1 << 24) - 1)
_TABLES: dict[int, tuple] = {}


def _tables(n: int) -> tuple:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _TABLES:
        _TABLES[size] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _TABLES[size]


def run_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all ``size``-byte runs of ``data`` (uint8)."""
    power, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[:len(data)], out=total[1:])
    return mix64((total[size:] - total[:-size]) * inverse[:len(data) - size + 1])


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive numbers."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def suffixes(data: np.ndarray, ends: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple:
    """(first start, number of starts, anchor hash) of the suffixes of the texts
    that stand in ``data`` one after another and end at ``ends``."""
    lows, counts, anchors = [], [], []
    short = np.zeros(len(data) + 1, np.int32)  # starts with fewer than span bytes
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    np.add.at(short, np.maximum(starts, ends - span + 1), 1)
    np.add.at(short, ends, -1)
    whole = np.cumsum(short[:-1], dtype=np.int32) == 0
    for at in range(0, len(data) - span + 1, PIECE):
        part = data[at:at + PIECE + span - 1]
        n = len(part) - span + 1
        hashes = run_hashes(part, gram)
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (window_least(keys, span - gram + 1) & _PLACE).astype(np.int64)
        i = np.flatnonzero(whole[at:at + n])
        if len(i):
            a = anchor[i]
            first = np.flatnonzero(np.concatenate(
                [[True], (a[1:] != a[:-1]) | (i[1:] != i[:-1] + 1)]))
            lows.append(i[first] + at)
            counts.append(np.diff(np.append(first, len(i))))
            anchors.append(hashes[a[first]])
    if not lows:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    return np.concatenate(lows), np.concatenate(counts), np.concatenate(anchors)


# --- shards -----------------------------------------------------------------------

def pack_batches(batches: Iterator) -> Iterator:
    """(doc_id, text) to shards: ids, sizes in bytes, and the texts, compressed."""
    import pyarrow as pa
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1)

    def shard(ids, texts):
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())),
             pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
             pa.array([squeeze.compress(b"".join(texts))], pa.binary())],
            ["ids", "sizes", "texts"])

    ids: list = []
    texts: list = []
    held = 0
    for batch in batches:
        for doc, text in zip(batch["doc_id"], batch["text"]):
            text = text.as_buffer().to_pybytes()
            if ids and held + len(text) > SHARD_BYTES:
                yield shard(ids, texts)
                ids, texts, held = [], [], 0
            ids.append(doc.as_py())
            texts.append(text)
            held += len(text)
    if ids:
        yield shard(ids, texts)


def _shards(batches: Iterator) -> Iterator:
    """(row, bytes, ends, doc_ids with nulls as the last, doc_ids) of each shard."""
    import zstandard

    loose = zstandard.ZstdDecompressor()
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch["ids"][row].as_py()
            ends = np.cumsum(batch["sizes"][row].values.to_numpy(), dtype=np.int64)
            data = np.frombuffer(loose.decompress(batch["texts"][row].as_buffer().to_pybytes()),
                                 np.uint8)
            order = np.array([_LAST if i is None else i for i in ids], np.int64)
            yield batch, row, data, ends, order, ids


def _lists(values: np.ndarray, cuts: np.ndarray):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.append(cuts, len(values)).astype(np.int32)),
                                    pa.array(values))


def _heads(x: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else x.astype(int)


def _owners(anchor: np.ndarray, ranges: int) -> tuple:
    """The range of an anchor and the 32 bits that name it there."""
    return ((anchor % np.uint64(ranges)).astype(np.int64),
            ((anchor // np.uint64(ranges)) & np.uint64(0xFFFFFFFF)).astype(np.uint32))


def anchor_batches(batches: Iterator, ranges: int) -> Iterator:
    """Shards to (part, shard, names): names of the shard's anchors in one range, one
    that stands in several documents of the shard twice."""
    import pyarrow as pa

    for batch, row, data, ends, order, _ in _shards(batches):
        low, _, anchor = suffixes(data, ends)
        if not len(low):
            continue
        doc = order[np.searchsorted(ends, low, side="right")]
        at = np.argsort(anchor)
        anchor, doc = anchor[at], doc[at]
        head = _heads(anchor)
        several = np.minimum.reduceat(doc, head) < np.maximum.reduceat(doc, head)
        part, name = _owners(np.repeat(anchor[head], 1 + several), ranges)
        at = np.argsort(part, kind="stable")
        part, name = part[at], name[at]
        cuts = _heads(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[cuts]), pa.array(np.repeat(batch["shard"][row].as_py(), len(cuts))),
             _lists(name.view(np.int32), cuts)], ["part", "shard", "names"])


def repeat_batches(batches: Iterator) -> Iterator:
    """All (part, shard, names) of a range to those of the names that repeat."""
    import pyarrow as pa

    some = [b for b in batches if b.num_rows]
    if not some:
        return
    got = pa.Table.from_batches(some).combine_chunks()
    column = got["names"].chunk(0)
    sizes = np.diff(column.offsets.to_numpy())
    names = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    part = np.repeat(got["part"].to_numpy(), sizes)
    at = np.lexsort((names, part))
    same = (names[at][1:] == names[at][:-1]) & (part[at][1:] == part[at][:-1])
    again = np.zeros(len(names), bool)
    again[at[1:]] |= same
    again[at[:-1]] |= same
    row, names = row[again], names[again]
    cuts = _heads(row)
    if len(cuts):
        yield pa.RecordBatch.from_arrays(
            [pa.array(got["part"].to_numpy()[row[cuts]]),
             pa.array(got["shard"].to_numpy()[row[cuts]]), _lists(names, cuts)],
            ["part", "shard", "names"])


# --- suffixes to their ranges -------------------------------------------------------

SUFFIXES = ("part long, shard long, row array<int>, doc array<long>, start array<int>,"
            " n array<int>, lost array<int>, packed boolean, bytes binary")


def prefix_hashes(data: np.ndarray, *starts: np.ndarray) -> list:
    """Hashes of the SPAN-byte strings at ``starts`` (each ascending) of ``data``."""
    out = [np.zeros(len(s), np.uint64) for s in starts]
    for at in range(0, len(data) - SPAN + 1, PIECE):
        cuts = [np.searchsorted(s, (at, at + PIECE)) for s in starts]
        if any(a < b for a, b in cuts):
            hashes = run_hashes(data[at:at + PIECE + SPAN - 1], SPAN)
            for o, s, (a, b) in zip(out, starts, cuts):
                o[a:b] = hashes[s[a:b] - at]
    return out


def suffix_batches(batches: Iterator, ranges: int) -> Iterator:
    """Shards with the ``repeats`` they learnt to their suffixes, a row for each range.
    Of equal suffixes of a shard only those of its least document carry bytes;
    the others are marked lost."""
    import pyarrow as pa
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1)
    for batch, row, data, ends, order, _ in _shards(batches):
        told = batch["repeats"][row].values
        if told is None or not len(told):
            continue
        parts = np.asarray(told.field("part"))
        names = told.field("names")
        offsets = names.offsets.to_numpy()
        sizes = np.diff(offsets)
        flat = names.values.to_numpy()[offsets[0]:offsets[-1]].view(np.uint32)
        wanted = np.unique(np.repeat(parts, sizes).astype(np.uint64) << np.uint64(32)
                           | flat.astype(np.uint64))
        low, n, anchor = suffixes(data, ends)
        part, name = _owners(anchor, ranges)
        key = part.astype(np.uint64) << np.uint64(32) | name.astype(np.uint64)
        hit = wanted[np.searchsorted(wanted, key).clip(max=len(wanted) - 1)] == key
        low, n, part = low[hit], n[hit], part[hit]
        text = np.searchsorted(ends, low, side="right")
        doc = order[text]
        # equal first and last prefixes make equal suffixes
        first, last = prefix_hashes(data, low, low + n - 1)
        name = mix64(first ^ mix64(last + n.astype(np.uint64)))
        at = np.lexsort((doc, name))
        head = _heads(name[at])
        least = np.empty(len(name), np.int64)
        least[at] = np.repeat(doc[at[head]], np.diff(np.append(head, len(at))))
        lost = doc > least
        at = np.lexsort((low, lost, part))
        low, n, part, text, doc, lost = (x[at] for x in (low, n, part, text, doc, lost))
        sizes = np.where(lost, 0, n + SPAN - 1)
        to = np.cumsum(sizes)
        bytes_ = data[np.repeat(low - (to - sizes), sizes) + np.arange(int(sizes.sum()))]
        cuts = _heads(part)
        begin = np.concatenate([[0], ends[:-1]])[text]
        bounds = np.append((to - sizes)[cuts], len(bytes_))
        big = np.diff(bounds) >= PACK_BYTES
        texts = [squeeze.compress(bytes_[a:b].tobytes()) if z else bytes_[a:b].tobytes()
                 for a, b, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), big.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[cuts]), pa.array(np.repeat(batch["shard"][row].as_py(), len(cuts))),
             _lists(text.astype(np.int32), cuts), _lists(doc, cuts),
             _lists((low - begin).astype(np.int32), cuts), _lists(n.astype(np.int32), cuts),
             _lists(lost.astype(np.int32), cuts), pa.array(big), pa.array(texts, pa.binary())],
            ["part", "shard", "row", "doc", "start", "n", "lost", "packed", "bytes"])


# --- the index family ---------------------------------------------------------------

class Starts:
    """Starts in the order of the hashes of their prefixes: a suffix array.  A start's
    ``place`` is its row in the shard and its offset in the text."""

    FIELDS = ("key", "doc", "shard", "place")
    __slots__ = FIELDS

    def __init__(self, *columns):
        for name, column in zip(self.FIELDS, columns):
            setattr(self, name, column)

    def __len__(self):
        return len(self.key)

    def take(self, which) -> Starts:
        return Starts(*(getattr(self, f)[which] for f in self.FIELDS))

    def order(self) -> Starts:
        return self.take(np.argsort(self.key))

    @staticmethod
    def join(parts: list) -> Starts:
        return Starts(*(np.concatenate([getattr(p, f) for p in parts]) for f in Starts.FIELDS))


def own_losses(batch: Starts) -> np.ndarray:
    """Which of a batch's starts (ordered) have a prefix that also starts in a
    smaller document of the batch."""
    head = _heads(batch.key)
    if not len(head):
        return np.zeros(0, bool)
    least = np.minimum.reduceat(batch.doc, head)
    return batch.doc > np.repeat(least, np.diff(np.append(head, len(batch))))


def losses(mine: Starts, other: Starts) -> np.ndarray:
    """Which of ``mine`` have a prefix that a smaller document has in ``other``.
    Both are ordered, and hold a prefix for one document only."""
    if not len(other):
        return np.zeros(len(mine), bool)
    at = np.searchsorted(other.key, mine.key).clip(max=len(other) - 1)
    return (other.key[at] == mine.key) & (other.doc[at] < mine.doc)


class IndexFamily:
    """Levels of starts of geometric sizes; a prefix is kept for its least document."""

    def __init__(self):
        self.levels: dict[int, Starts] = {}

    def add(self, starts: Starts) -> list:
        """Takes a batch in; the starts that lost, of the batch and of the levels."""
        new = starts.order()
        gone = own_losses(new)
        out = [new.take(gone)]
        new = new.take(~gone)
        for size, level in list(self.levels.items()):
            mine, theirs = losses(new, level), losses(level, new)
            out += [new.take(mine), level.take(theirs)]
            if theirs.any():
                self.levels[size] = level.take(~theirs)
            new = new.take(~mine)
        size = 0
        while size in self.levels:  # equal sizes merge
            new = Starts.join([self.levels.pop(size), new]).order()
            size += 1
        self.levels[size] = new
        return [x for x in out if len(x)]


def _runs(parts: list) -> Iterator:
    """(shard, place, n) arrays of lost starts to one row a shard; runs that follow each
    other are one."""
    import pyarrow as pa

    if not parts:
        return
    shard, place, n = (np.concatenate(c) for c in zip(*parts))
    at = np.lexsort((place, shard))
    shard, place, n = shard[at], place[at], n[at]
    fresh = np.ones(len(shard), bool)
    fresh[1:] = (shard[1:] != shard[:-1]) | (place[1:] != place[:-1] + n[:-1])
    first = np.flatnonzero(fresh)
    total = np.add.reduceat(n, first)
    shard, place = shard[first], place[first]
    cuts = _heads(shard)
    yield pa.RecordBatch.from_arrays(
        [pa.array(shard[cuts]), _lists((place >> 32).astype(np.int32), cuts),
         _lists((place & 0xFFFFFFFF).astype(np.int32), cuts),
         _lists(total.astype(np.int32), cuts)], ["shard", "row", "start", "n"])


def lost_batches(batches: Iterator, batch: int = BATCH) -> Iterator:
    """The suffixes of a range to the starts that lost: (shard, row, start, n)."""
    import zstandard

    loose = zstandard.ZstdDecompressor()
    family = IndexFamily()
    held: list = []
    size = 0

    def absorb() -> list:
        return [(x.shard, x.place, np.ones(len(x), np.int64)) for x in family.add(Starts.join(held))]

    for got in batches:
        if not got.num_rows:
            continue
        sizes = np.diff(got["row"].offsets.to_numpy())
        shard = np.repeat(got["shard"].to_numpy(), sizes)
        row, doc, start, n, lost = (got[c].flatten().to_numpy()
                                    for c in ("row", "doc", "start", "n", "lost"))
        place, n, gone = row.astype(np.int64) << 32 | start, n.astype(np.int64), lost == 1
        out = [(shard[gone], place[gone], n[gone])] if gone.any() else []
        data = np.frombuffer(b"".join(
            loose.decompress(x) if z else x
            for x, z in zip(got["bytes"].to_pylist(), got["packed"].to_pylist())), np.uint8)
        shard, place, doc, n = (x[~gone] for x in (shard, place, doc, n))
        begins = np.cumsum(n + SPAN - 1) - (n + SPAN - 1)
        before = np.concatenate([[0], np.cumsum(n)])
        a = 0
        while a < len(n):  # whole suffixes, about a batch of starts
            b = max(a + 1, int(np.searchsorted(before, before[a] + batch, side="right")) - 1)
            which = np.repeat(np.arange(a, b), n[a:b])
            within = np.arange(before[a], before[b]) - before[which]
            text = data[begins[a]:begins[b - 1] + n[b - 1] + SPAN - 1]
            at = begins[which] - begins[a] + within
            held.append(Starts(prefix_hashes(text, at)[0], doc[which], shard[which],
                               place[which] + within))
            size += int(before[b] - before[a])
            if size >= batch:
                out += absorb()
                held, size = [], 0
            a = b
        yield from _runs(out)
    if held:
        yield from _runs(absorb())


# --- cutting ------------------------------------------------------------------------

def cut_shards(batches: Iterator) -> Iterator:
    """Shards with their lost starts to the documents of ``dedup_substrings``."""
    import pyarrow as pa

    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for batch, at, data, ends, _, ids in _shards(batches):
        begins = np.concatenate([[0], ends[:-1]])
        told = batch["lost"][at].values
        gone = np.zeros(len(data) + 1, np.int32)
        if told is not None and len(told):
            row, start, n = (told.field(c).flatten().to_numpy() for c in ("row", "start", "n"))
            low = begins[row] + start
            np.add.at(gone, low, 1)
            np.add.at(gone, low + n + SPAN - 1, -1)
        cut = np.cumsum(gone[:-1], dtype=np.int32) > 0
        # a removed run ends with its document
        edge = np.zeros(len(data) + 1, bool)
        edge[begins] = edge[ends] = True
        prior = np.concatenate([[False], cut[:-1]])
        opens = np.flatnonzero(cut & (~prior | edge[:-1]))
        after = np.concatenate([cut[1:], [False]])
        closes = np.flatnonzero(cut & (~after | edge[1:])) + 1
        of = np.searchsorted(ends, opens, side="right")
        removed = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(of, np.arange(len(ends) + 1)).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(opens - begins[of]), pa.array(closes - begins[of])],
                                       ["begin", "end"]))
        left = np.concatenate([[0], np.cumsum(~cut)])
        bounds = left[np.append(begins, len(data))]
        for a in range(0, len(ids), 1000):  # Arrow batches of bounded rows
            b = min(a + 1000, len(ids))
            kept = data[begins[a]:ends[b - 1]][~cut[begins[a]:ends[b - 1]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a:b], pa.int64()), pa.array(ends[a:b] - begins[a:b]),
                 removed[a:b].cast(span),
                 pa.Array.from_buffers(pa.binary(), b - a, [
                     None, pa.py_buffer((bounds[a:b + 1] - bounds[a]).astype(np.int32)),
                     pa.py_buffer(np.ascontiguousarray(kept))])],
                ["doc_id", "n_bytes", "removed", "kept"])


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, ``removed``
    (array of struct(begin, end): bytes of the UTF-8 text, end exclusive,
    ascending, maximal), ``kept`` (binary: the other bytes; a cut may fall
    within a character).

    Rows with one doc_id are one document here: they take nothing from each
    other, and a string twice in a document stays.  A null doc_id ranks after
    all others; null doc_ids are one document.  A null text counts as empty;
    texts under SPAN bytes stay.  Very long texts are hashed in pieces.  An
    empty table gives an empty table; other columns are ignored."""
    base = docs.select("doc_id", no_null_text("text").cast("binary").alias("text"))
    shards = bucketed(base.mapInArrow(on_workers("suffix_dedup", "pack_batches"),
                                      "ids array<long>, sizes array<long>, texts binary")
                      .withColumn("shard", F.monotonically_increasing_id()), "shard")
    total = shards.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    ranges = max(1, -(-(total[0] or 0) // RANGE_BYTES))
    owned = shards.mapInArrow(on_workers("suffix_dedup", "anchor_batches", ranges),
                              "part long, shard long, names array<int>")
    repeats = (owned.repartitionById(ranges, F.col("part").cast("int"))
               .mapInArrow(on_workers("suffix_dedup", "repeat_batches"),
                           "part long, shard long, names array<int>")
               .groupBy("shard").agg(F.collect_list(F.struct("part", "names")).alias("repeats")))
    lost = (shards.join(repeats.hint("shuffle_hash"), "shard")
            .mapInArrow(on_workers("suffix_dedup", "suffix_batches", ranges), SUFFIXES)
            .repartitionById(ranges, F.col("part").cast("int"))
            .mapInArrow(on_workers("suffix_dedup", "lost_batches"),
                        "shard long, row array<int>, start array<int>, n array<int>")
            .groupBy("shard").agg(F.collect_list(F.struct("row", "start", "n")).alias("lost")))
    return shards.join(lost.hint("shuffle_hash"), "shard", "left").mapInArrow(
        on_workers("suffix_dedup", "cut_shards"),
        "doc_id long, n_bytes long, removed array<struct<begin:bigint,end:bigint>>, kept binary")


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written as a table bucketed by ``key`` in the shared checkpoint folder and
    read back: joins on ``key`` move only their other side."""
    spark = df.sparkSession
    path = scratch_path(spark, "bucketed")
    name = f"bucketed_{path.rsplit('-', 1)[1]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its name only: the files are not the catalog's
    return out
