import numpy as np

from candlestack.llm import ngram_join as N


def test_counters_and_sets_survive_packing():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 70_000, 1 << 12).astype(np.uint32)
    assert (N.unpack_counts(N.pack_counts(counts)) == counts).all()
    for n in (1, 7, 8, 1_000):
        tokens = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        second = rng.permutation(tokens)[:N.prefix_length(len(tokens), 0.75)]
        whole, inside = N.unpack_set(*N.pack_set(tokens, second))
        upper = np.uint64(0xFFFFFFFFFFFF0000)
        assert (whole == tokens & upper).all()
        assert (inside == np.sort(second) & upper).all()
