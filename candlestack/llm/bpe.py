"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut into chunks where a rolling hash of its last bytes hits a
pattern, so texts that share passages share chunks, wherever the passage
stands.  A chunk is encoded once and its ids are kept (bounded memo of the
worker) for all documents that hold it.  Chunk joins are then repaired: the
cut may have fallen into a word, so around each join the text between the
last sure token border of the left chunk and the first of the right one is
encoded again, and the repair reaches further until both chunks agree that a
token ends there.

A sure border is a white-space byte after a visible ASCII byte: the
pre-tokeniser ends a piece there whatever stands before or after, so the
spliced ids are those of the whole text.

Byte-level vocabularies only (each id stands for a byte string).  Chunks in
ASCII and Latin letters are encoded by tiktoken with the ranks of the given
vocabulary; chunks with other characters, on which the two libraries' tables
could differ, by the tokenizers library itself.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from candlestack.llm.common import no_null_text, on_workers, slices

#: Bytes in the rolling window; bits that must be set at a cut (2 KB chunks on
#: average); bytes in a chunk at least.
WINDOW = 16
CUT_BITS = 11
LEAST_CHUNK = 256
#: Ids that a worker keeps for reuse.
MEMO_IDS = 4_000_000

#: Fixed value: the pre-tokeniser's pattern of byte-level vocabularies.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ–-…€]*")


def byte_alphabet() -> dict:
    """Character to byte of byte-level vocabularies: visible Latin-1
    characters stand for themselves, the other bytes for the characters from
    256 on in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """The encoder and the byte string of every id of a vocabulary file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        table = {i: bytes(alphabet[c] for c in tok) for tok, i in spec["model"]["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ranks = {bytes([b]): b for b in range(256)}
        for a, b in merges:
            ranks.setdefault(bytes(alphabet[c] for c in a + b), len(ranks))
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        table.update({i: s.encode() for s, i in special.items()})
        self.strings = [table.get(i, b"") for i in range(max(table) + 1)]
        self.lengths = np.array([len(s) for s in self.strings], np.int64)
        self.digits = [str(i) for i in range(len(self.strings))]
        ids = {s: i for i, s in table.items() if i not in special.values()}
        self.of_rank = np.zeros(len(ranks) + len(special), np.uint32)
        for s, r in ranks.items():
            self.of_rank[r] = ids[s]
        marks = {}
        for s, i in special.items():
            marks[s] = len(ranks) + len(marks)
            self.of_rank[marks[s]] = i
        self.fast = tiktoken.Encoding("chunks", pat_str=PIECES, mergeable_ranks=ranks,
                                      special_tokens=marks)
        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()

    def encode(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text):
            return self.of_rank[np.array(self.fast.encode(text, allowed_special="all"), np.int64)]
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.strings.__getitem__, ids.tolist())).decode("utf-8", "replace")


_VOCABULARIES: dict = {}
_MEMO: dict = {}
_MEMO_SIZE = [0]


def forget() -> None:
    """Drop the vocabularies and the memo, which the next task makes again."""
    _VOCABULARIES.clear()
    _MEMO.clear()
    _MEMO_SIZE[0] = 0


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def cut_points(data: np.ndarray) -> np.ndarray:
    """Ascending offsets after which the rolling hash of the last WINDOW
    bytes ends in CUT_BITS ones, never inside a UTF-8 character.  Depends on
    those bytes alone."""
    if len(data) <= WINDOW:
        return np.zeros(0, np.int64)
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(2654435761)
    factor, width = np.uint32(0x01000193), 1
    while width < WINDOW:  # hash of 2w bytes from two hashes of w bytes
        power = np.uint32(pow(int(factor), width, 1 << 32))
        h[width:] = h[width:] + h[:-width] * power
        width *= 2
    mask = np.uint32((1 << CUT_BITS) - 1)
    at = np.flatnonzero(((h >> np.uint32(15)) & mask) == mask) + 1
    at = at[(at >= WINDOW) & (at < len(data))]
    return at[(data[at] & 0xC0) != 0x80]


def sure_borders(data: np.ndarray) -> np.ndarray:
    visible = (data > 32) & (data < 127)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    return np.flatnonzero(space[1:] & visible[:-1]) + 1


def _chunk(vocab: Vocabulary, path: str, chunk: bytes) -> tuple:
    """(ids, end offset of each id) of a chunk, encoded once while kept."""
    key = (path, chunk)
    got = _MEMO.get(key)
    if got is None:
        ids = vocab.encode(chunk.decode("utf-8"))
        got = (ids, np.cumsum(vocab.lengths[ids]).astype(np.uint32))
        if _MEMO_SIZE[0] > MEMO_IDS:
            _MEMO.clear()
            _MEMO_SIZE[0] = 0
        _MEMO[key] = got
        _MEMO_SIZE[0] += len(ids) + 16
    return got


def encode_text(text: str, path: str) -> np.ndarray:
    """The ids of a whole text, by chunks."""
    vocab = vocabulary(path)
    raw = text.encode("utf-8")
    if len(raw) < LEAST_CHUNK:
        return _chunk(vocab, path, raw)[0] if raw else np.zeros(0, np.uint32)
    data = np.frombuffer(raw, np.uint8)
    cuts, last = [0], 0
    for c in cut_points(data).tolist():
        if c - last >= LEAST_CHUNK:
            cuts.append(c)
            last = c
    n = len(raw)
    cuts.append(n)
    if len(cuts) == 2:
        return _chunk(vocab, path, raw)[0]
    borders = sure_borders(data)
    firsts = np.searchsorted(borders, cuts, "right")  # first border behind each cut
    lasts = np.searchsorted(borders, cuts, "left") - 1  # last border before each cut
    out, done = [], 0  # done: the ids of raw[:done] are out
    for i in range(len(cuts) - 1):
        a, b = cuts[i], cuts[i + 1]
        begin = a if a == 0 else int(borders[firsts[i]]) if firsts[i] < len(borders) else n
        end = b if b == n else int(borders[lasts[i + 1]]) if lasts[i + 1] >= 0 else 0
        if not a <= begin < end <= b:
            continue  # no sure border inside: the next repair takes this chunk in
        ids, ends = _chunk(vocab, path, raw[a:b])
        lo = 0 if begin == a else int(np.searchsorted(ends, begin - a)) + 1
        hi = int(np.searchsorted(ends, end - a)) + 1
        if (lo and ends[lo - 1] != begin - a) or ends[hi - 1] != end - a:
            continue  # the chunk does not agree: repair further
        if done < begin:
            out.append(_chunk(vocab, path, raw[done:begin])[0])
        out.append(ids[lo:hi])
        done = end
    if done < n:
        out.append(vocab.encode(raw[done:].decode("utf-8")))
    return np.concatenate(out)


def encode_batches(batches: Iterator, path: str) -> Iterator:
    import pyarrow as pa

    for batch in slices(batches):
        ids = [encode_text(t, path) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))],
            ["doc_id", "ids"])


def decode_batches(batches: Iterator, path: str) -> Iterator:
    import pyarrow as pa

    vocab = vocabulary(path)
    for batch in slices(batches):
        texts = [None if x is None else vocab.decode(np.array(x, np.int64))
                 for x in batch["ids"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())],
                                         ["doc_id", "text"])


def digest_batches(batches: Iterator, path: str) -> Iterator:
    """Encode, decode the ids again, and give the digests of both."""
    import pyarrow as pa

    vocab = vocabulary(path)
    digit, string = vocab.digits.__getitem__, vocab.strings.__getitem__
    for batch in slices(batches):
        n, ids_sha, text_sha = [], [], []
        for text in batch["text"].to_pylist():
            ids = encode_text(text, path).tolist()
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(digit, ids)).encode()).hexdigest())
            back = b"".join(map(string, ids)).decode("utf-8", "replace")
            text_sha.append(hashlib.sha256(back.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
             pa.array(text_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", no_null_text("text").alias("text"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no ids; very long texts are encoded whole,
    chunk by chunk; repeated rows each come back; special tokens written out
    in a text become their ids, as in the library; an empty table gives an
    empty table; other columns are ignored.  No shuffle."""
    return _texts(docs).mapInArrow(on_workers("bpe", "encode_batches", path),
                                   "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); special tokens are kept; bytes that
    are no UTF-8 become U+FFFD; null ids give a null text."""
    return encoded.select("doc_id", "ids").mapInArrow(on_workers("bpe", "decode_batches", path),
                                                      "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256 (the text decoded from those ids) of every row of ``docs``."""
    return _texts(docs).mapInArrow(
        on_workers("bpe", "digest_batches", path),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
