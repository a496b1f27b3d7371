"""Distributed exact quantiles equal pandas' linear quantiles."""

import random

import pandas as pd
import pytest

from candlestack.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def test_matches_pandas_with_hot_key_and_ties(spark):
    rnd = random.Random(3)
    rows = [("hot", float(rnd.randint(0, 50))) for _ in range(3000)]       # many ties
    rows += [("cold", rnd.uniform(-5, 5)) for _ in range(17)]
    rows += [("one", 42.0), ("nulls", None), ("nulls", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {(r.k, r.p): r.quantile for r in exact_quantiles(df, ["k"], "v", PROBS).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    for k, g in pdf.groupby("k"):
        for p in PROBS:
            assert got[(k, p)] == pytest.approx(g["v"].dropna().quantile(p)), (k, p)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.tuples(st.sampled_from(["a", "b"]),
                                 st.integers(min_value=-50, max_value=50)),
                       min_size=1, max_size=60),
       p=st.sampled_from([0.0, 0.05, 0.3, 0.5, 0.99, 1.0]))
def test_random_groups_match_pandas(spark, values, p):
    df = spark.createDataFrame([(k, float(v)) for k, v in values], "k string, v double")
    got = {r.k: r.quantile for r in exact_quantiles(df, ["k"], "v", [p]).collect()}
    pdf = pd.DataFrame(values, columns=["k", "v"]).astype({"v": float})
    want = pdf.groupby("k")["v"].quantile(p).to_dict()
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_bounded_describe_equals_distributed(spark):
    from candlestack.operators import bars as B
    from candlestack.operators import stats as S
    from candlestack.sources.tables import read_table
    from conftest import SF_SMOKE

    bars = B.bars_from_ticks(read_table(spark, SF_SMOKE, "lineitem"))
    a = {(r.symbol, r.statistic): tuple(r)[2:] for r in S.describe_exact(bars, digits=4).collect()}
    b = {(r.symbol, r.statistic): tuple(r)[2:]
         for r in S.describe_exact(bars, digits=4, bounded=True).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])
