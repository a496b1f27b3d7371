"""Token-id files: canonical length-limited Huffman coding from global counts.

Writing: texts are tokenised once into a written table of ids; the ids are
counted over the whole corpus (one number per id of the vocabulary), and a
length-limited Huffman code is built from the counts by package-merge.  The
documents are dealt by ranges of doc_id, sorted, and cut into blocks of whole
documents; a block holds its code bits, the bit offset of every
``CHECKPOINT``-th id, and the ids and lengths of its documents.  Blocks are
rows of Parquet files, so Spark's writer commits them and a lost task writes
its own again.  The code travels as its lengths alone (canonical code).

Reading: every block decodes on its own; within a block all checkpoints are
decoded side by side from a table indexed by the next bits.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlestack.llm.bpe import byte_alphabet
from candlestack.llm.common import no_null_text, on_workers, scratch_path, slices

BLOCK_IDS = 65_536
CHECKPOINT = 128
END_ID = 2
#: Words whose ids a worker keeps.
MEMO_WORDS = 800_000
#: Characters cut at once; a longer text is cut at white space before.
CUT_CHARS = 1 << 21

BLOCK = ("part int, block int, first long, n_ids long, doc_ids array<long>,"
         " doc_lengths array<int>, checkpoints binary, bits binary")


# --- code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Code length per id (0: id does not occur), at most ``limit`` bits, with
    the smallest total.  Package-merge: a level's list holds the ids by count
    merged with pairs of the level below; the first 2n - 2 entries of the top
    list tell, level by level, how many of the rarest ids get one bit more."""
    used = np.flatnonzero(counts)
    n = len(used)
    lengths = np.zeros(len(counts), np.uint8)
    if n < 2:
        lengths[used] = 1
        return lengths
    limit = limit or max(16, int(n - 1).bit_length() + 2)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    order = used[np.lexsort((used, counts[used]))]
    leaf = counts[order].astype(np.float64)
    merged, levels = leaf, [np.ones(n, bool)]
    for _ in range(limit - 1):
        m = len(merged) // 2 * 2
        packages = merged[0:m:2] + merged[1:m:2]
        both = np.concatenate([leaf, packages])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        levels.append(rank < n)
    take, by_rank = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        by_rank[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = by_rank
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id): each the last plus one, shifted to its length."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, last = 0, 0
    for length in np.unique(lengths[order]):
        ids = order[lengths[order] == length]
        code <<= int(length) - last
        codes[ids] = code + np.arange(len(ids), dtype=np.uint64)
        code += len(ids)
        last = int(length)
    return codes


class Coder:
    """Encoder and decoder of blocks for one set of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths)
        self.width = max(1, int(lengths.max(initial=1)))
        self._tables: tuple | None = None

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(checkpoints, bits).  Codes are at most 32 bits, so each 32-bit word
        holds the start of at least one code and words are sums of the parts
        that fall into them."""
        if not len(ids):
            return b"", b""
        size = self.lengths[ids]
        end = np.cumsum(size)
        at = end - size
        word = at >> 5
        frame = self.codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        n = int((end[-1] + 31) >> 5)
        out = np.zeros(n + 1, np.uint64)
        out[word[starts]] = np.add.reduceat(frame >> np.uint64(32), starts)
        out[word[starts] + 1] += np.add.reduceat(frame & np.uint64(0xFFFFFFFF), starts)
        return (at[::CHECKPOINT].astype("<u4").tobytes(), out[:n].astype(">u4").tobytes())

    def tables(self) -> tuple:
        """For each value of the next ``width`` bits: the id and its length."""
        if self._tables is None:
            order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
            order = order[self.lengths[order] > 0]
            span = 1 << (self.width - self.lengths[order])
            ids = np.zeros(1 << self.width, np.uint32)
            filled = np.repeat(order, span)
            ids[:len(filled)] = filled
            self._tables = ids, self.lengths[ids]
        return self._tables

    def decode(self, checkpoints: bytes, bits: bytes, n: int) -> np.ndarray:
        if not n:
            return np.zeros(0, np.uint32)
        ids, size = self.tables()
        words = np.frombuffer(bits, ">u4").astype(np.uint64)
        pair = words << np.uint64(32)
        pair[:-1] |= words[1:]
        pair = np.append(pair, np.uint64(0))
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        out = np.zeros((len(at), CHECKPOINT), np.uint32)
        mask, top = np.uint64((1 << self.width) - 1), 64 - self.width
        full = n // CHECKPOINT
        for k in range(min(CHECKPOINT, n)):
            if k == n - full * CHECKPOINT and full < len(at):
                at = at[:full]  # the last run is shorter
            peek = ((pair[at >> 5] >> (top - (at & 31)).astype(np.uint64)) & mask).astype(np.int64)
            out[:len(at), k] = ids[peek]
            at = at + size[peek]
        return out.reshape(-1)[:n]


# --- tokenising -------------------------------------------------------------

#: A full stop or comma at a word's end that other punctuation precedes, with
#: which it makes one piece of the pre-tokeniser.  The search starts at the two
#: marks, which are found faster than any punctuation.
JOINED = re.compile(r"[.,](?:(?<=[^\w\s].)|(?<=_.))(?:\s|\Z)")


#: A word in lower case whose characters the normaliser leaves as they are and
#: the pre-tokeniser takes as one run of letters: Latin, Cyrillic, Han, Hangul.
_LETTER = "a-z\u00df-\u00f6\u00f8-\u024f\u0430-\u045f\u4e00-\u9fa5\uac00-\ud7a3"
LETTERS = re.compile(f"[{_LETTER}]+")
#: A word of such letters and of ASCII digits and marks; the pieces that the
#: pre-tokeniser cuts it into.
CLEAR = re.compile(f"[!-@\\[-`{{-~{_LETTER}]+")
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^0-9{_LETTER}]+")
#: Where texts are cut; the characters (from U+FFFF on: all) of no such word.
SPACES = " \t\n\r"
GAP = re.compile(f"[{SPACES}]")
UNCLEAR = np.array([not CLEAR.fullmatch(c) and c not in SPACES for c in map(chr, range(1 << 16))])
#: Bytes of such words by kind; other characters than ASCII are letters.
SPACE, LETTER, DIGIT, MARK = range(4)
KINDS = np.full(256, MARK, np.uint8)
KINDS[list(SPACES.encode())] = SPACE
KINDS[list(b"abcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = LETTER
KINDS[list(b"0123456789")] = DIGIT
#: The normaliser and pre-tokeniser for which that holds.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]"
                                           r"|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def plain_words(text: str) -> list:
    """The text cut at spaces (and, where each is a piece of its own, before
    full stops and commas), in lower case: words the library gives the ids
    that they have in the text.  Texts with marks of special tokens, which are
    found before the normaliser lowers them, or with a capital sigma, whose
    lower case depends on its place in Python, keep their case and stops."""
    text = text.replace("\n", " ").replace("\t", " ")
    if "<|" not in text and "\u03a3" not in text:
        text = text.lower()
        if not JOINED.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ")
    return text.split(" ")


def lowered(text: str) -> str:
    """The text in lower case, but for the texts that ``plain_words`` keeps."""
    return text if "<|" in text or "\u03a3" in text else text.lower()


def stretch_groups(texts: list) -> Iterator:
    """The texts in lower case in groups of CUT_CHARS or so: (numbers of the
    texts, stretches), in order.  Longer texts are cut at white space."""
    of, group, size = [], [], 0
    for i, text in enumerate(map(lowered, texts)):
        at = 0
        while at < len(text):
            gap = GAP.search(text, at + CUT_CHARS)
            stop = gap.start() if gap else len(text)
            if group and size + stop - at > CUT_CHARS:
                yield of, group
                of, group, size = [], [], 0
            of.append(i)
            group.append(text[at:stop])
            size += stop - at
            at = stop
    if group:
        yield of, group


def cut_texts(texts: list) -> tuple:
    """All texts' units one after the other, as an Arrow array, and how many come
    before the end of each text.  A unit is a piece of PIECES, or a whole word
    if it is not of CLEAR; the library gives each the ids it has in its text."""
    import pyarrow as pa

    every = "\n".join([*texts, "", ""])  # two bytes may be read past the last text
    raw = np.frombuffer(every.encode(), np.uint8)
    kind = KINDS[raw]
    start = kind == DIGIT
    start[0] = True
    start[1:] |= kind[1:] != kind[:-1]
    # 's and the like are pieces where their mark begins a run of marks
    at = np.flatnonzero(raw == ord("'"))
    at = at[start[at]]
    one, two = raw[at + 1], raw[at + 2]
    short = np.isin(one, list(b"stmd"))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
    long |= (one == ord("l")) & (two == ord("l"))
    start[at[short | long] + 1] = False
    start[at[short] + 2] = True
    start[at[long] + 3] = True
    inside = kind != SPACE
    # the first byte of each character
    lead = np.arange(len(raw)) if len(every) == len(raw) else np.flatnonzero(
        (raw & 0xC0) != 0x80)
    codes = np.frombuffer(every.encode("utf-32-le"), np.uint32)
    unclear = lead[UNCLEAR[np.minimum(codes, len(UNCLEAR) - 1)]]
    if "<|" in every:
        unclear = np.append(unclear, np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|"))))
    if len(unclear):
        word = np.cumsum(~inside, dtype=np.int32)
        whole = np.zeros(word[-1] + 1, bool)
        whole[word[unclear]] = True
        start[1:] &= ~(whole[word[1:]] & inside[:-1])
    start &= inside
    ends = lead[np.cumsum([len(t) + 1 for t in texts])]
    before = np.searchsorted(np.flatnonzero(start), ends)
    text = raw[inside]
    offsets = np.append(np.flatnonzero(start[inside]), len(text)).astype(np.int32)
    units = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [
        None, pa.py_buffer(offsets), pa.py_buffer(text)])
    return units, before


#: Stands for the end of a piece in tiktoken's byte strings.
WORD_END = "\n"


def merge_tables(model: dict) -> tuple | None:
    """(ranks by byte string, id of each rank, whether the rank ends a piece) of
    a word-level BPE for tiktoken, or None where its ids could differ from the library's.

    tiktoken joins neighbours whose bytes make any token, the library those of
    its list.  They agree if every token, encoded by itself, comes out whole:
    neighbours that make up a token then have the history that they have in it
    alone, so they are its listed pair.  A token comes out whole if its two
    parts do and nothing joins across them first."""
    suffix = model["end_of_word_suffix"]
    if not suffix or any(model[k] for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback",
            "ignore_merges")):
        return None
    alphabet = byte_alphabet()
    symbols = sorted(alphabet, key=alphabet.get)
    raw = {c: bytes([alphabet[c]]) for c in symbols}
    raw |= {c + suffix: raw[c] + WORD_END.encode() for c in symbols}
    pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    rank, parts = {p: i for i, p in enumerate(pairs)}, {}

    def spine(token: str, side: int, until: int) -> list:
        """The tokens at one edge of ``token`` as it grows, and when each goes."""
        out = [(token, until)]
        while token in parts:
            (token, until) = parts[token][side], rank[parts[token]]
            out.append((token, until))
        return out

    for i, (a, b) in enumerate(pairs):
        if a not in raw or b not in raw or a + b in raw or a.endswith(suffix):
            return None
        for x, x_until in spine(a, 1, i):
            for y, y_until in spine(b, 0, i):
                # of equal pairs that overlap the left one joins first
                r = rank.get((x, y), i)
                if r < x_until and r <= y_until and r < i:
                    return None
        if (a + b).endswith(suffix) != b.endswith(suffix):
            return None
        parts[a + b] = (a, b)
        raw[a + b] = raw[a] + raw[b]
    ranks = {r: i for i, r in enumerate(raw.values())}
    if len(ranks) != len(raw) or not raw.keys() <= model["vocab"].keys():
        return None
    return (ranks, np.array([model["vocab"][t] for t in raw]),
            np.array([t.endswith(suffix) for t in raw]))


class WordEncoder:
    """Ids of whole texts from ids of their space-separated words.

    The vocabulary's pre-tokeniser never crosses white space and its
    normaliser treats each character by itself or with the marks that follow
    it, so a text's ids are those of its words, one after the other.  Words
    not yet known are encoded by the library; those that its normaliser would
    leave as they are and that are cut by PIECES go to tiktoken with the
    vocabulary's merges, piece by piece, where texts are cut into these pieces
    to begin with.  The memo is cleared when full."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        top = max(max(spec["model"]["vocab"].values()),
                  max(t["id"] for t in spec["added_tokens"]))
        self.size = top + 1
        self.dtype = np.dtype("<u2" if top < 65_536 else "<u4")
        self.memo: dict = {"": b""}
        self.bpe = None
        if (spec["normalizer"], spec["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER):
            tables = merge_tables(spec["model"])
            if tables is not None:
                import tiktoken

                self.bpe = tiktoken.Encoding(
                    "words", pat_str=f"[^{WORD_END}]+{WORD_END}", mergeable_ranks=tables[0],
                    special_tokens={})
                self.of_rank, self.ends = tables[1].astype(self.dtype), tables[2]

    def _learn(self, words: list) -> None:
        if self.bpe is not None:
            clear, every = words, " ".join(words)
            if not CLEAR.fullmatch(every.replace(" ", "")):
                clear = [w for w in words if CLEAR.fullmatch(w)]
                every = " ".join(clear)
            if every != every.lower() or any(m in every for m in self.marks):
                clear = [w for w in clear
                         if w == w.lower() and not any(m in w for m in self.marks)]
            words = set(words).difference(clear)
            letters = [w for w in clear if LETTERS.fullmatch(w)]
            self._note(self.bpe, letters, letters, None)
            others = list(set(clear).difference(letters))
            cut = [PIECES.findall(w) for w in others]
            self._note(self.bpe, [p for c in cut for p in c], others, [len(c) for c in cut])
        words = list(words)
        done = self.lib.encode_batch_fast(words, add_special_tokens=False)
        for word, got in zip(words, done):
            self.memo[word] = np.array(got.ids, self.dtype).tobytes()

    def _note(self, bpe, pieces: list, words: list, n_pieces: list | None) -> None:
        """Keep the ids of ``words`` that have so many (None: one) of ``pieces``."""
        if not words:
            return
        ranks = np.array(bpe.encode_ordinary(WORD_END.join([*pieces, ""])))
        ends = (np.flatnonzero(self.ends[ranks]) + 1) * self.dtype.itemsize
        if n_pieces is not None:
            ends = ends[np.cumsum(n_pieces) - 1]
        raw, at = self.of_rank[ranks].tobytes(), 0
        for word, end in zip(words, ends.tolist()):
            self.memo[word] = raw[at:end]
            at = end

    def _know(self, need: list | set) -> None:
        """Have all words that ``need`` names in the memo."""
        new = [w for w in need if w not in self.memo]
        if new and len(self.memo) + len(new) > MEMO_WORDS:
            self.memo = {"": b""}
            new = [w for w in need if w]
        if new:
            self._learn(new)

    def _encode_cut(self, texts: list) -> list:
        """Arrow tells the units apart, so that only distinct ones meet the memo."""
        import pyarrow as pa
        import pyarrow.compute as pc

        units, before = cut_texts(texts)
        if not len(units):
            return [b""] * len(texts)
        coded = units.dictionary_encode()
        # no unit holds a line feed: cut apart faster than by to_pylist
        every = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()),
                                         coded.dictionary)
        distinct = pc.binary_join(every, "\n")[0].as_py().split("\n")
        self._know(distinct)
        ids = pa.array([self.memo[w] for w in distinct], pa.binary())
        _, offsets, raw = ids.take(coded.indices).buffers()
        ends = np.frombuffer(offsets, np.int32)[before].tolist()
        raw = memoryview(raw or b"")  # none where no unit has an id
        return [bytes(raw[a:b]) for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list) -> list:
        """The ids of each text as bytes of little-endian numbers."""
        if self.bpe is not None:
            done: list = [[] for _ in texts]
            for of, group in stretch_groups(texts):
                for i, ids in zip(of, self._encode_cut(group)):
                    done[i].append(ids)
            return [b"".join(d) for d in done]
        out: list = []
        for at in range(0, len(texts), 64):
            words = [plain_words(t) for t in texts[at:at + 64]]
            self._know(set().union(*words))
            get = self.memo.__getitem__
            out += [b"".join(map(get, w)) for w in words]
        return out


_ENCODERS: dict = {}


def forget() -> None:
    """Drop the encoders, which the next task makes again."""
    _ENCODERS.clear()


def word_encoder(path: str) -> WordEncoder:
    # a task has its core; the library's own threads only wait for each other
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def id_batches(batches: Iterator, path: str, end_id: int) -> Iterator:
    import pyarrow as pa

    enc = word_encoder(path)
    end = np.array([end_id], enc.dtype).tobytes()
    for batch in slices(batches):
        raw = [x + end for x in enc.encode(batch["text"].to_pylist())]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(raw, pa.binary())],
                                         ["doc_id", "ids"])


def count_batches(batches: Iterator, dtype: str) -> Iterator:
    import pyarrow as pa

    total = np.zeros(0, np.int64)
    for batch in slices(batches):
        n = np.bincount(np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype),
                        minlength=len(total))
        n[:len(total)] += total
        total = n
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])],
                                     ["id", "n"])


# --- files ------------------------------------------------------------------

def block_batches(batches: Iterator, dtype: str, lengths: bytes) -> Iterator:
    """Sorted (doc_id, ids) of one range to its blocks."""
    import pyarrow as pa
    from pyspark import TaskContext

    coder = Coder(np.frombuffer(lengths, np.uint8))
    part = TaskContext.get().partitionId()
    names = ["part", "block", "first", "n_ids", "doc_ids", "doc_lengths", "checkpoints", "bits"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
             pa.list_(pa.int32()), pa.binary(), pa.binary()]
    block, first, docs, pieces, size = 0, 0, [], [], 0
    step = np.dtype(dtype).itemsize

    def close():
        ids = np.frombuffer(b"".join(pieces), dtype)
        marks, bits = coder.encode(ids)
        row = [part, block, first, len(ids), docs, [len(p) // step for p in pieces], marks, bits]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    for batch in slices(batches):
        for doc, raw in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist()):
            docs.append(doc)
            pieces.append(raw)
            size += len(raw) // step
            if size >= BLOCK_IDS:
                yield close()
                block, first, docs, pieces, size = block + 1, first + size, [], [], 0
    if docs:
        yield close()


def write_token_files(docs: DataFrame, path: str, out: str, end_id: int = END_ID) -> None:
    """Encode every row of ``docs`` (doc_id, text) with the vocabulary file
    ``path`` and write ``out``/code (the code lengths) and ``out``/blocks, in
    ascending doc_id order (part, then block, then place in the block).

    A null text counts as empty; an empty text is its end id alone; very long
    texts fill a block of their own; repeated rows are written each; a null
    doc_id comes last; an empty table gives files without blocks; other
    columns are ignored."""
    spark = docs.sparkSession
    dtype = word_encoder(path).dtype.str
    ids = scratch_path(spark, "token-ids")
    (docs.select("doc_id", no_null_text("text").alias("text"))
     .mapInArrow(on_workers("token_files", "id_batches", path, end_id),
                 "doc_id long, ids binary")
     .write.option("compression", "zstd").parquet(ids))
    tokens = spark.read.parquet(ids)
    counts = (tokens.mapInArrow(on_workers("token_files", "count_batches", dtype),
                                "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())  # at most the vocabulary
    total = np.zeros(1 + max((r.id for r in counts), default=0), np.int64)
    for r in counts:
        total[r.id] = r.n
    lengths = code_lengths(total).tobytes()
    spark.createDataFrame([(bytearray(lengths),)], "lengths binary").coalesce(1).write.parquet(
        f"{out}/code")
    ranged = (tokens.repartitionByRange(F.col("doc_id").asc_nulls_last())
              .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "ids"))
    (ranged.mapInArrow(on_workers("token_files", "block_batches", dtype, lengths), BLOCK)
     .write.option("compression", "none").parquet(f"{out}/blocks"))


def doc_batches(batches: Iterator, lengths: bytes, keep_ids: bool) -> Iterator:
    import pyarrow as pa

    coder = Coder(np.frombuffer(lengths, np.uint8))
    for batch in slices(batches):
        for row in batch.to_pylist():
            ids = coder.decode(row["checkpoints"], row["bits"], row["n_ids"])
            ends = np.cumsum(row["doc_lengths"])
            begins = ends - row["doc_lengths"]
            pieces = [ids[a:b] for a, b in zip(begins.tolist(), ends.tolist())]
            out = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + begins),
                   pa.array(row["doc_lengths"], pa.int64()),
                   pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces], pa.int64())]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            if keep_ids:
                out.append(pa.array([p.astype(np.int32) for p in pieces], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)


def read_token_files(spark: SparkSession, out: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens (with the end
    id), ids_crc32 of every document in the files, and its ``ids`` if asked."""
    lengths = bytes(spark.read.parquet(f"{out}/code").first().lengths)
    blocks = spark.read.schema(BLOCK).parquet(f"{out}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per write task
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = blocks.join(F.broadcast(offsets), "part").withColumn(
        "before", F.col("offset") + F.col("first"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.select("before", "n_ids", "doc_ids", "doc_lengths", "checkpoints",
                         "bits").mapInArrow(
        on_workers("token_files", "doc_batches", lengths, keep_ids),
        schema + (", ids array<int>" if keep_ids else ""))
