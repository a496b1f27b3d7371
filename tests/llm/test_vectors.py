"""Ops 1 and 3 against brute force."""
import numpy as np

from candlestack.llm import ann, embedding_dedup
from candlestack.llm.queries import QUERIES
from llm_data import SF, SF2, edge, empty  # noqa: F401

NAN, INF = float("nan"), float("inf")


def load(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    return (np.array([r.vec_id for r in rows]),
            np.array([r.embedding for r in rows], float), [r.label for r in rows])


def test_nearest_is_ranked_exact_and_found(spark):
    ids, x, _ = load(spark, SF2)
    got = {}
    for r in QUERIES["op1_ann"](spark, SF2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q in ids[ids % 100 == 0]:
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        for _, v, s in mine:
            assert v != q and s == d[ids == v][0]
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        best = sorted((dd, v) for dd, v in zip(d, ids) if v != q)[:10]
        hits += len({v for _, v in best} & {v for _, v, _ in mine})
    assert hits >= 0.9 * 10 * len(got)


def test_nearest_over_many_lists_and_blocks(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 8))
    x[200:700] = x[0] + rng.normal(size=(500, 8)) * 1e-3  # a dense group, many lists
    df = spark.createDataFrame([(i, v.tolist(), "e") for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, rank string")
    got = ann.nearest(df, df.where("vec_id % 50 = 0"), k=10, list_rows=50, block_rows=64,
                      query_rows=5, probe_ratio=1.4).collect()
    hits = 0
    for q in range(0, 1500, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        best = sorted((dd, v) for v, dd in enumerate(d) if v != q)[:10]
        hits += len({v for _, v in best} & {r.vec_id for r in got if r.query_id == q})
    assert len(got) == 300 and hits >= 270


def edge_vectors(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [0.0, 0.0], 1), (3, None, 1),
            (4, [NAN, 1.0], 1), (5, [INF, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 0.0], 2),
            (8, [2.0, 0.0], 1), (8, [2.0, 0.0], 1), (9, [1.0, 0.0], None), (10, [], 1),
            (11, [1.0, 0.0, 0.0], 1), (100, [-1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    return spark.createDataFrame([(*r, "x", 3) for r in rows],
                                 "vec_id long, embedding array<double>, label int,"
                                 " component string, list int")


def test_vector_edge_rows(spark):
    df = edge_vectors(spark)
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 100 = 0"), k=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    # usable, of the usual dimension: 0, 1, 7, 8, 9, 100
    assert [v for _, v, _ in sorted(got[0])] == [7, 9, 1, 8, 100]
    assert [v for _, v, _ in sorted(got[100])] == [0, 7, 9, 1, 8]
    links = sorted(((r.vec_id, r.n_links, r.component_id, r.kept)
                    for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    group = {0: 4, 1: 4, 8: 4}  # 0, 1, 8, 8 and the null id link
    want = [(v, group.get(v, 0), 0 if v in group else v, v not in (1, 8))
            for v in (0, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10, 11, 100)] + [(None, 4, 0, False)]
    assert links == sorted(want, key=str)


def test_empty_vectors(spark):
    none = edge_vectors(spark).limit(0)
    assert ann.nearest(none, none).count() == 0
    assert embedding_dedup.near_duplicates(none).count() == 0


def brute_links(ids, x, labels, t=0.93):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array(labels)
    link = (x @ x.T >= t) & (lab[:, None] == lab[None])
    np.fill_diagonal(link, False)
    comp = ids.copy()
    while True:
        new = np.array([min(c, comp[link[i]].min(initial=c)) for i, c in enumerate(comp)])
        if (new == comp).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, link.sum(1), comp)}
        comp = new


def test_dedup_matches_brute_force(spark):
    for sf in (SF, SF2):
        ids, x, labels = load(spark, sf)
        got = {r.vec_id: (r.n_links, r.component_id)
               for r in QUERIES["op3_embedding_dedup"](spark, sf).collect()}
        assert got == brute_links(ids, x, labels)


def test_dedup_dense_groups_are_counted_whole(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 16))
    x = np.concatenate([c + rng.normal(size=(n, 16)) * 0.05 for c, n in
                        zip(centres, (300, 90, 40, 5, 2, 1))])
    x[10:60] = x[0]  # equal vectors
    ids = np.arange(len(x)) * 3
    df = spark.createDataFrame([(int(i), v.tolist(), 4) for i, v in zip(ids, x)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(
        df, window=4, segment_rows=64, block_rows=32).collect()}
    assert got == brute_links(ids, x, [4] * len(x))


def test_dedup_finds_pairs_in_a_dense_label(spark):
    # distinct vectors at cosine 0.8, none linked, and 150 planted pairs at 0.94
    rng = np.random.default_rng(5)
    n, pairs = 6000, 150
    def unit(v):
        return v / np.sqrt((v * v).sum(-1, keepdims=True))
    common = unit(rng.normal(size=64))
    own = rng.normal(size=(n, 64))
    own = unit(own - np.outer(own @ common, common))
    noise = rng.normal(size=(pairs, 64))
    noise -= np.outer(noise @ common, common)
    first = own[:pairs]
    noise = unit(noise - (noise * first).sum(1, keepdims=True) * first)
    own[pairs:2 * pairs] = 0.7 * first + np.sqrt(1 - 0.49) * noise
    x = np.sqrt(0.8) * common + np.sqrt(0.2) * own
    df = spark.createDataFrame([(i, v.tolist(), 4) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(
        df, run_block_rows=700).collect()}
    want = brute_links(np.arange(n), x, [4] * n)
    planted = [i for i in range(pairs, 2 * pairs) if want[i][0]]
    found = sum(got[i] == want[i] for i in planted)
    print("dense label: found", found, "of", len(planted))
    assert len(planted) > 140 and found >= 0.99 * len(planted)
