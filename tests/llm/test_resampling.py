"""Op 12 against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from candlestack.llm import resampling as R
from candlestack.llm.queries import QUERIES

from llm_data import EDGE, SF, documents, edge, empty  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000
            for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10000) / ((s[b] + 1.0)
                                                                     * (big_t + 10000))))
            for b in range(10000)]
    out, able = [], []
    for i, text in rows:
        f = buckets(text)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if len(words(text)) >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score",
                                               "rank").collect()), key=str)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert result(QUERIES["op12_resampling"](spark, SF)) == brute(rows, target)


def test_edge_rows_and_empty_tables(spark, edge, empty):
    target = spark.createDataFrame([("lorem ipsum dolor",), (None,)], "text string")
    want = brute([r[:2] for r in EDGE], ["lorem ipsum dolor", None])
    assert result(R.resample(edge, target)) == want
    assert result(R.resample(edge, target.limit(0))) == brute([r[:2] for r in EDGE], [])
    assert R.resample(empty, target).count() == 0


def test_one_document_in_a_third_of_all_rows_is_split(spark):
    rng = random.Random(3)
    rows = [(7, "one two three " * 8)] * 700 + [
        (rng.randrange(10_000), " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(15, 40))))
        for _ in range(1400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("a b c three one",)], "text string")
    # an even share of ties: ranks are a permutation, alike rows may swap
    assert result(R.resample(df, target, percent=40)) == sorted(
        (tuple(r) for r in _with_percent(rows, ["a b c three one"], 40)), key=str)
    runs = R.sorted_runs(df.selectExpr(
        "doc_id", "30L n_words", "1L n_features", "0L weight", "0L score"))
    parts = [len(p) for p in R.ranked(runs)[0].rdd.glom().collect()]
    assert len(parts) == 8 and max(parts) <= 2 * len(rows) / 8


def _with_percent(rows, target, percent):
    out = [list(r[:4]) for r in brute(rows, target)]
    able = [r for r in out if r[1] >= 57]  # 20 words: 20 + 19 + 18 features
    able.sort(key=lambda r: (-r[3], r[0], r[1]))
    ranks = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return [(*r, ranks.get(id(r))) for r in out]


def test_crcs_of_pieces_and_long_words():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("aZ9é中-") for _ in range(rng.choice((1, 5, 70, 300))))
                      for _ in range(rng.randrange(60))).encode() for _ in range(40)]
    long = b" ".join(rng.choice(texts) for _ in range(400)) + b" " + b"y" * 3_000_000 + b" tail of it"
    for text in [*texts, long]:
        want = sorted(buckets(text.decode()))
        got = np.concatenate([b.reshape(-1) for _, b in R.features([text])] or [np.zeros(0)])
        assert sorted(got[got >= 0].tolist()) == want
