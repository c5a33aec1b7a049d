"""Exact percentiles of few large groups, and histograms that shuffle bins only."""

import numpy as np
import pytest

from kinelake.operators import statistics as st


@pytest.mark.parametrize("bins", [2, 1024])
def test_exact_quantiles(spark, bins):
    rng = np.random.default_rng(2)
    groups = {1: rng.normal(size=500), 2: np.repeat([0.1, 0.2], [7, 90]), 3: np.array([5.0]), 4: rng.choice([1e-300, 1e300, -1e300, 0.0], 60), 5: np.array([-np.inf, 1.0, np.inf, np.inf])}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [(1, None), (1, float("nan")), (6, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    want = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.975, "e": 1.0}
    got = {r["g"]: r for r in st.exact_quantiles(df, "g", "v", want, bins).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    for k in (1, 2, 3, 4):
        for n, q in want.items():
            assert np.isclose(got[k][n], np.quantile(groups[k], q), rtol=1e-12, atol=1e-12), (k, n)
    assert (got[5]["a"], got[5]["e"]) == (-np.inf, np.inf)
    assert st.exact_quantiles(df.limit(0), "g", "v", want).count() == 0


def test_histogram_shuffles_bins_only(spark):
    df = spark.range(10_000).selectExpr("cast(id % 3 as int) as channel", "cast(id as double) as v")
    ranges = st.value_ranges(df, ["channel"], "v").collect()
    h = st.histogram(df, ranges, ["channel"], "v", 64)
    assert "Join" not in h._jdf.queryExecution().optimizedPlan().toString()
    assert h.agg({"count": "sum"}).first()[0] == 10_000
    q = {r["channel"]: r["m"] for r in st.histogram_quantiles(h, ["channel"], {"m": 0.5}, 64).collect()}
    assert all(abs(v - 5000) < 200 for v in q.values())
