"""Ops 6 and 9 against the tokenizers library, and round trips."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from candlestack.llm import bpe, token_files
from candlestack.llm.queries import QUERIES, vocabulary_file
from candlestack.session import scratch_path
from llm_data import EDGE, SF, documents, edge, empty  # noqa: F401

BYTE = vocabulary_file("byte_bpe_50k.json")
WORD = vocabulary_file("word_bpe_49k.json")
TRICKY = [
    "it's we'll I'd  two  spaces\n\n\nlines\t\ttabs  nbsp em \r\n end ",
    "<|endoftext|>", "a<|endoftext|> b <|endof text|>  <|endoftext|>x" * 40,
    "中文" * 900 + " mixed " + "\U0001f600" * 300, "é é Σσς İİ",
    "1234567890" * 300, "!?..." * 500, " " * 4000 + "x" + "\n" * 3000, "'s'S 't don't",
    "\x00\x01 \x1c\x1d \x85 z", "<|startoftext|> in <|startoftext|>text",
]


def random_texts(seed, n=60):
    rng = random.Random(seed)
    alphabet = "abcdefghij  \n\t.,'0123éß中\U0001f600 "
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(500, 5000))) for _ in range(5)]
    return ["".join(rng.choice([rng.choice(shared), "".join(
        rng.choice(alphabet) for _ in range(rng.randint(0, 900)))]) for _ in range(4))
        for _ in range(n)]


@pytest.mark.parametrize("text", TRICKY)
def test_chunks_encode_tricky_texts_exactly(text):
    lib = Tokenizer.from_file(BYTE)
    ids = bpe.encode_text(text, BYTE)
    assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids
    assert bpe.vocabulary(BYTE).decode(ids) == lib.decode(ids.tolist(), skip_special_tokens=False)


def test_chunks_encode_random_texts_exactly():
    lib = Tokenizer.from_file(BYTE)
    for text in random_texts(1):
        assert bpe.encode_text(text, BYTE).tolist() == lib.encode(
            text, add_special_tokens=False).ids


def test_shared_passages_are_cut_alike():
    rng = np.random.default_rng(0)
    passage = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    a = np.frombuffer(b"head " * 100 + passage, np.uint8)
    b = np.frombuffer(b"another start " * 333 + passage, np.uint8)
    cuts_a = {len(a) - c for c in bpe.cut_points(a).tolist()}
    cuts_b = {len(b) - c for c in bpe.cut_points(b).tolist()}
    inside = {c for c in cuts_a if c < 19_900}
    assert inside and inside == {c for c in cuts_b if c < 19_900}


def test_query_matches_the_library(spark):
    lib = Tokenizer.from_file(BYTE)
    texts = dict(documents(spark).select("doc_id", "text").collect())
    rows = QUERIES["op9_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(
            lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edge_rows_round_trip(spark, edge, empty):
    back = bpe.decode(bpe.encode(edge, BYTE), BYTE).collect()
    assert sorted(map(str, back)) == sorted(
        str(type(back[0])(doc_id=r[0], text=r[1] or "")) for r in EDGE)
    assert bpe.encode(empty, BYTE).count() == 0
    assert bpe.round_trip_digests(empty, BYTE).count() == 0


# --- token files ---------------------------------------------------------------

def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 3000):
        counts = rng.zipf(1.5, n).astype(np.int64)
        counts[rng.random(n) < 0.2] = 0
        counts[0] = 5
        used = counts > 0
        lengths = token_files.code_lengths(counts)
        assert ((lengths > 0) == used).all()
        if used.sum() > 1:
            assert abs(sum(2.0 ** -lengths[used].astype(float)) - 1) < 1e-9
            import heapq
            heap = [(int(c), 0) for c in counts[used]]
            heapq.heapify(heap)
            best = 0
            while len(heap) > 1:  # plain Huffman: the total no code can beat
                a, b = heapq.heappop(heap)[0], heapq.heappop(heap)[0]
                best += a + b
                heapq.heappush(heap, (a + b, 0))
            assert (lengths[used] * counts[used]).sum() >= best
            if lengths.max() < 16:
                assert (lengths[used] * counts[used]).sum() == best


def test_coder_round_trip():
    rng = np.random.default_rng(3)
    for n_ids, size in ((1, 10), (2, 1), (700, 128), (700, 129), (40_000, 70_001)):
        ids = np.minimum(rng.zipf(1.2, size) - 1, n_ids - 1).astype(np.uint32)
        lengths = token_files.code_lengths(np.bincount(ids, minlength=n_ids))
        coder = token_files.Coder(lengths)
        assert (coder.decode(*coder.encode(ids), len(ids)) == ids).all()


def expected_files(rows):
    lib = Tokenizer.from_file(WORD)
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document_in_order(spark):
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op6_token_files"](spark, SF).collect())
    assert got == expected_files(rows)


def test_files_of_edge_rows(spark, edge, empty, monkeypatch):
    out = scratch_path(spark, "test-files")
    token_files.write_token_files(edge, WORD, out)
    got = sorted((tuple(r) for r in token_files.read_token_files(spark, out).collect()),
                 key=lambda r: r[1])
    assert got == expected_files([r[:2] for r in EDGE])
    out = scratch_path(spark, "test-files")
    token_files.write_token_files(empty, WORD, out)
    assert token_files.read_token_files(spark, out).count() == 0


def test_word_memo_is_exact_when_it_overflows(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_WORDS", 50)
    lib, enc = Tokenizer.from_file(WORD), token_files.WordEncoder(WORD)
    texts = TRICKY + random_texts(4, 30)
    for text, raw in zip(texts, enc.encode(texts)):
        assert np.frombuffer(raw, enc.dtype).tolist() == lib.encode(
            text, add_special_tokens=False).ids


def test_joined_stops_are_found_as_by_the_plain_pattern():
    import itertools
    import re

    plain = re.compile(r"(?:[^\w\s]|_)[.,](?:\s|\Z)")
    for n in range(5):
        for t in map("".join, itertools.product("a_.,-\n \u00e9", repeat=n)):
            assert bool(plain.search(t)) == bool(token_files.JOINED.search(t)), t


def test_words_of_letters_go_to_the_bpe_alone(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    path = vocabulary_file("word_bpe_49k.json")
    token_files.word_encoder(path)
    assert token_files.os.environ["TOKENIZERS_PARALLELISM"] == "false"
    enc, lib = token_files.WordEncoder(path), Tokenizer.from_file(path)
    texts = ["Plain words, straße über один 汉字 한국 it's",
             "Ångström naı̈ve ﬁne 각 ª x9 AΣ İx a\nb",
             "line feeds\u0085and <|endoftext|> MARKS kept <|Strasse"]
    direct, note = set(), enc._note

    def spy(of, words, *args):
        if of is enc.bpe:
            direct.update(words)
        note(of, words, *args)

    monkeypatch.setattr(enc, "_note", spy)
    got = enc.encode(texts)
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, enc.dtype).tolist() == lib.encode(
            text, add_special_tokens=False).ids
    assert {"plain", "straße", "один", "汉字"} <= direct
    assert not {"it's", "x9", "ﬁne", "ª", "MARKS"} & direct
    # a file with other patterns than these takes the library's whole way
    monkeypatch.setattr(token_files, "PRE_TOKENIZER", None)
    plain = token_files.WordEncoder(path)
    assert plain.bpe is None and plain.encode(texts) == got


def test_cut_words_need_no_library(monkeypatch):
    """Words with digits and marks took the library's whole way."""
    enc, lib = token_files.WordEncoder(WORD), Tokenizer.from_file(WORD)
    slow, keep = [], enc.lib

    class Spy:
        def encode_batch_fast(self, words, **how):
            slow.extend(words)
            return keep.encode_batch_fast(words, **how)

    monkeypatch.setattr(enc, "lib", Spy())
    texts = ["nder.### (565) it's we'll x9y don''t 'sa a_b été's 12,5% --word-- straße!!",
             "ﬁne <|endoftext|> ABC σ Σ ı̈"] + random_texts(7, 20)
    for text, raw in zip(texts, enc.encode(texts)):
        assert np.frombuffer(raw, enc.dtype).tolist() == lib.encode(
            text, add_special_tokens=False).ids
    assert "ﬁne" in slow
    assert not {"nder.###", "(565)", "it's", "x9y", "a_b", "12,5%", "straße!!"} & set(slow)


def test_words_of_many_texts_meet_the_memo_once():
    """Every word of every text was looked up, distinct ones once in 64 texts more."""
    met = []

    class Memo(dict):
        def __getitem__(self, word):
            met.append(word)
            return super().__getitem__(word)

    enc, lib = token_files.WordEncoder(WORD), Tokenizer.from_file(WORD)
    enc.memo = Memo(enc.memo)
    text = "It's the same words, over and over: straße 42. "
    expected = lib.encode(text * 9, add_special_tokens=False).ids
    for raw in enc.encode([text * 9] * 200):
        assert np.frombuffer(raw, enc.dtype).tolist() == expected
    assert "straße" in met and len(met) == len(set(met))


def test_texts_are_cut_as_the_patterns_cut_their_words():
    import re

    rng = random.Random(11)
    texts = ["", " ", "'", "'s", "x'll", " 'Sa", "\U0001f600", "\r\n", "'re're''ve'm!'d"]
    for alphabet in ("ab's'tre'll've'md0.,é中  \n",
                     "a's0|<~é中ﬁA\u0301\U0001f600\x0b\x85 \t\r\n"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
                  for _ in range(400)]
    for group in (*([t] for t in texts), texts):
        units, before = token_files.cut_texts(group)
        units, start = units.to_pylist(), 0
        for text, end in zip(group, before.tolist()):
            words = [w for w in re.split("[ \t\r\n]+", text) if w]
            assert units[start:end] == [
                p for w in words for p in (
                    token_files.PIECES.findall(w)
                    if token_files.CLEAR.fullmatch(w) and "<|" not in w else [w])], text
            start = end
        assert start == len(units)


@pytest.mark.parametrize("chars", [1, 40, 5000])
def test_long_texts_are_cut_at_white_space(monkeypatch, chars):
    monkeypatch.setattr(token_files, "CUT_CHARS", chars)
    enc, lib = token_files.WordEncoder(WORD), Tokenizer.from_file(WORD)
    texts = [*TRICKY, "", "\x0b", *random_texts(8, 6), "a 'b's\r\nc  "]
    got = enc.encode(texts)
    assert len(got) == len(texts) and enc.encode([]) == []
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, enc.dtype).tolist() == lib.encode(
            text, add_special_tokens=False).ids


def test_merges_that_any_neighbours_could_make_take_the_library():
    import json

    with open(WORD, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ranks, ids, ends = token_files.merge_tables(model)
    assert len(ranks) == len(ids) == len(ends) == len(model["vocab"])
    base = [t for t in model["vocab"] if len(t.removesuffix("</w>")) == 1]

    def small(*merges):
        tokens = base + [a + b for a, b in merges]
        return model | {"vocab": {t: i for i, t in enumerate(tokens)},
                        "merges": [list(m) for m in merges]}

    assert token_files.merge_tables(small(("a", "b"), ("ab", "c</w>"))) is not None
    # "bc</w>" is made before "ab", so "abc</w>" never comes of its listed pair
    assert token_files.merge_tables(small(("b", "c</w>"), ("a", "b"), ("ab", "c</w>"))) is None
    assert token_files.merge_tables(small(("a", "a"), ("a", "aa"))) is None
    assert token_files.merge_tables(small(("a", "a"), ("aa", "a"))) is not None
