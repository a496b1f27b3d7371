"""Op 13 against brute force."""
import random
import re
import zlib
from collections import Counter

import pytest

from candlestack.llm import spelling as P
from candlestack.llm.queries import QUERIES

from llm_data import EDGE, SF, SF2, documents, edge, empty  # noqa: F401


def counts(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def near(words):
    """Words at distance one, by the strings with one letter left out."""
    by = {}
    for w in words:
        by.setdefault(w, set()).add(w)
        for i in range(len(w)):
            by.setdefault(w[:i] + w[i + 1:], set()).add(w)
            by.setdefault((w[:i], w[i + 1:]), set()).add(w)
    out = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            out[w] |= {x for x in by[w[:i], w[i + 1:]] if x != w}  # replaced
            if w[:i] + w[i + 1:] in out:  # deleted
                out[w].add(w[:i] + w[i + 1:])
                out[w[:i] + w[i + 1:]].add(w)
    return out


def brute(n):
    around = near(n)
    form = {}
    for w, xs in around.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(around[w]), form[w] and n[form[w]]))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in
                  df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("sf", [SF, SF2])
def test_query_matches_brute_force(spark, sf):
    rows = [tuple(r) for r in documents(spark, sf).select("doc_id", "text").collect()]
    got = result(QUERIES["op13_spelling"](spark, sf))
    assert got == brute(counts(rows))
    assert any(r[1] for r in got)


def test_edge_rows_and_empty_table(spark, edge, empty):
    assert result(P.variants(edge)) == brute(counts([r[:2] for r in EDGE]))
    assert P.variants(empty).count() == 0


def test_chains_ties_and_letters_beyond_ascii(spark):
    rng = random.Random(2)
    words = ["abcdefgh", "abcdefghi", "abcdefgi", "abcdefi", "äbcdefgh", "ÄBCDEFGH", "aabbccdd",
             "aabbccddd", "ÿÿÿÿÿÿÿ", "ÿÿÿÿÿÿÿÿ", "mississippi", "mississipi", "misissippi"]
    rows = [(i, " ".join(rng.choices(words, [10 ** (k % 4) for k in range(len(words))], k=200)))
            for i in range(60)] + [(None, "z" * 4_000 + " " + "z" * 4_001)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(P.variants(df))
    assert got == brute(counts(rows))
    assert any(r[2] not in (r[0], r[1]) for r in got)  # a chain of two forms


def test_every_near_pair_shares_a_signature():
    rng = random.Random(9)
    for _ in range(300):
        w = "".join(rng.choice("abcdé") for _ in range(rng.randint(7, 20)))
        i = rng.randrange(len(w) + 1)
        for x in (w[:i] + "q" + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice("abz") + w[i + 1:]):
            if x == w or not x:
                continue
            pair = [v.encode("latin-1") for v in sorted((w, x), key=len)]
            rows, longer, sig = P.signature_rows(pair)
            short = set(sig[(rows == 0) & (longer == 0)].tolist())
            other = set(sig[(rows == 1) & (longer == (len(w) != len(x)))].tolist())
            assert short & other, (w, x)
