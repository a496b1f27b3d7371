"""Op 11 against brute force."""
import hashlib
import random

import pytest

from candlestack.llm import suffix_dedup as S
from candlestack.llm.queries import QUERIES

from llm_data import EDGE, SF, documents, edge, empty  # noqa: F401


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by a dictionary of all strings."""
    first = {}
    docs = [(i, (t or "").encode()) for i, t in rows]
    for i, t in docs:
        rank = (i is None, i or 0)
        for k in range(len(t) - 49):
            s = t[k:k + 50]
            if s not in first or rank < first[s]:
                first[s] = rank
    out = []
    for i, t in docs:
        rank = (i is None, i or 0)
        cut = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k:k + 50]] < rank:
                cut[k:k + 50] = b"\x01" * 50
        spans = sum(1 for k in range(len(t)) if cut[k] and (not k or not cut[k - 1]))
        kept = bytes(b for b, c in zip(t, cut) if not c)
        out.append((i, len(t), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(rows):
    return sorted(((r["doc_id"], r["n_bytes"], sum(x["end"] - x["begin"] for x in r["removed"]),
                    len(r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
                   for r in rows), key=str)


def test_query_matches_brute_force(spark):
    got = sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
                  for r in QUERIES["op11_suffix_dedup"](spark, SF).collect()), key=str)
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    assert got == brute(rows)


def test_edge_rows_and_empty_table(spark, edge, empty):
    # the two very long texts repeat a 40-byte period within and across documents
    assert digest(S.dedup_substrings(edge).collect()) == brute([r[:2] for r in EDGE])
    assert S.dedup_substrings(empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_planted_passages_of_all_lengths(spark, monkeypatch, seed):
    # small shards, ranges and batches, so that levels of the family merge
    monkeypatch.setattr(S, "RANGE_BYTES", 4_000)
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdefghij é中 ") for _ in range(n))

    passages = [noise(n) for n in (30, 48, 49, 50, 51, 70, 200)] + ["ab" * 60, "x" * 130]
    rows = []
    for _ in range(120):
        text = noise(rng.randrange(80))
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            text += p[rng.randrange(3):] + noise(rng.choice((0, 1, 30, 90)))
        rows.append((rng.choice((None, *range(40))), text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert digest(S.dedup_substrings(df).collect()) == brute(rows)


def test_family_in_small_batches_equals_one_batch():
    import numpy as np

    rng = np.random.default_rng(1)
    key = rng.integers(0, 300, 4_000).astype(np.uint64)
    doc = rng.integers(0, 50, 4_000)
    at = np.arange(4_000)
    all_ = S.Starts(key, doc, at, at)
    least = {}
    for k, d in zip(key.tolist(), doc.tolist()):
        least[k] = min(d, least.get(k, d))
    want = {i for i in range(4_000) if doc[i] > least[int(key[i])]}
    for size in (64, 333, 4_000):
        family = S.IndexFamily()
        got = [int(i) for b in range(0, 4_000, size) for x in family.add(all_.take(at[b:b + size]))
               for i in x.place]
        assert len(got) == len(set(got)) and set(got) == want
        assert sum(len(level) for level in family.levels.values()) == 4_000 - len(want)
        # sizes of the levels: the binary digits of the number of batches
        assert set(family.levels) == {i for i in range(8) if -(-4_000 // size) >> i & 1}
