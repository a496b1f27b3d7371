"""Op 8 against brute force."""
import random
import re

import pytest

from candlestack.llm import ngram_join

from llm_data import EDGE, SF2, documents, edge, empty  # noqa: F401


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y:
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k), i) if s else i)
                   for k, (i, s) in enumerate(sets)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()),
                  key=str)


def test_matches_brute_force_on_documents(spark):
    docs = documents(spark, SF2)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(ngram_join.link_components(docs)) == brute(rows)


def test_edge_rows(spark, edge, empty):
    assert result(ngram_join.link_components(edge, sketch_bits=10)) == brute(
        [r[:2] for r in EDGE])
    assert ngram_join.link_components(empty, sketch_bits=10).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_families_of_near_copies_and_shared_passages(spark, seed):
    # chains of edits, copies, and passages shared by unlinked texts
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(30)]
    rows, n = [], 0
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(8, 90))]
        for _ in range(rng.randint(1, 14)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            if rng.random() < 0.4:
                t = t + passage
            rows.append((n, " ".join(t)))
            n += 1
            if rng.random() < 0.5:
                base = t[:90]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(ngram_join.link_components(df, sketch_bits=8)) == brute(rows)


def test_two_families_that_do_not_link_are_not_paired_class_by_class(spark, monkeypatch):
    # whole texts with one edit each, and shorter ones: alike, but below the threshold
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:8 * i], f"x{i}", *base[8 * i + 1:]])) for i in range(12)]
    rows += [(100 + i, " ".join([*base[:9 * i + 6], f"y{i}", *base[9 * i + 7:77]]))
             for i in range(8)]
    made = {}
    write = ngram_join.materialize

    def counted(df, name):
        made[name] = (out := write(df, name)).count()
        return out

    monkeypatch.setattr(ngram_join, "materialize", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(ngram_join.link_components(df, sketch_bits=16))
    assert got == brute(rows) and len({r[2] for r in got}) == 2
    assert made["posts"] and made["rest"] == 0


def test_bitmaps_differ_in_no_more_bits_than_sets_in_tokens():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
            for n in (0, 1, 40, 3000)]
    sets += [sets[2][3:], np.union1d(sets[3][5:], sets[2])]
    maps = ngram_join.bitmaps(sets)
    assert maps.shape == (len(sets), ngram_join.MAP_LONGS)
    for x, p in zip(sets, maps):
        for y, q in zip(sets, maps):
            bits = int(np.unpackbits((p ^ q).view(np.uint8)).sum())
            apart = len(np.setxor1d(x, y))
            assert bits <= apart and (apart - bits) % 2 == 0


def test_steps_hold_few_sets_and_give_memory_back(monkeypatch):
    import pyarrow as pa

    from candlestack.llm import bpe, common

    held, sets, given = [], ngram_join.shingle_sets, []
    monkeypatch.setattr(ngram_join, "shingle_sets",
                        lambda texts, words: held.append(len(texts)) or sets(texts, words))
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    monkeypatch.setitem(bpe._VOCABULARIES, "v", "kept")
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(1_000)), pa.array([b"a b c d e f %d" % i for i in range(1_000)])],
        ["doc_id", "text"])
    out = list(common.on_workers("ngram_join", "survey_batches", 5, 10)(iter([rows])))
    assert sum(b["n"].null_count < len(b) and len(b) or 0 for b in out) == 1_000
    assert max(held) <= 200 and sum(held) == 1_000
    assert given == [1]  # when the task ends
    assert not bpe._VOCABULARIES  # what another step kept for its next task
    bpe._VOCABULARIES["v"] = "kept"
    common.forget_others("bpe")
    assert bpe._VOCABULARIES.pop("v") == "kept"
    common_now = common.give_back
    monkeypatch.undo()
    assert common.give_back is not common_now and common.give_back() is None
