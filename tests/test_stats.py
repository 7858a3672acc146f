import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.operators import stats


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), rng.integers(0, 20, 2000).astype(float)])
    grp = rng.integers(0, 3, len(vals))
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    out = stats.quantiles_long(df, ["x"], probs, ["g"], buckets=8).collect()
    for r in out:
        exp = np.percentile(vals[grp == r.g], probs[r.q_index] * 100)
        assert r.value == pytest.approx(exp, rel=1e-12, abs=1e-12)


def test_kth_smallest(spark):
    df = spark.range(1000).selectExpr("cast((id * 7919) % 1000 as double) as v")
    assert stats.kth_smallest(df, "v", lambda n: n * 0 + 10).first().kth == 9.0


def test_correlation_and_vif(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=500)
    b = a * 0.5 + rng.normal(size=500)
    c = rng.normal(size=500)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    corr = {(r.a, r.b): r.corr for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert corr[("a", "b")] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)
    assert corr[("b", "a")] == corr[("a", "b")]
    vif = {r.feature: r.vif for r in stats.vif(df, ["a", "b", "c"]).collect()}
    # least squares R^2 of a on (b, c, const)
    X = np.column_stack([b, c, np.ones_like(b)])
    res = a - X @ np.linalg.lstsq(X, a, rcond=None)[0]
    r2 = 1 - res.var() / a.var()
    assert vif["a"] == pytest.approx(1 / (1 - r2), rel=1e-6)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 10]], "x double")
    h = stats.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in h] == [2, 2, 1, 0, 1] and sum(r.n for r in h) == 6


def test_vif_of_dependent_and_constant_columns(spark):
    rows = [(float(i), 2.0 * i + 1, float((i * 7) % 11), 5.0, 0.0) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double, z double")
    got = {r.feature: r.vif for r in stats.vif(df, ["a", "b", "c", "k", "z"]).collect()}
    assert got["a"] == got["b"] == got["k"] == got["const"] == float("inf")
    assert 1.0 <= got["c"] < 2.0 and got["z"] is None


def test_kth_smallest_of_rank_zero_has_no_row(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "g string, v double")
    got = stats.kth_smallest(df, "v", lambda n: F.floor(F.lit(0.8) * n).cast("bigint"), ["g"]).collect()
    assert [tuple(r) for r in got] == [("a", 1.0)]


def test_ranks_are_exact_whatever_the_values(spark):
    """Ties, heavy tails, both signs, infinities, one value, nulls; against a sort."""
    import random
    from shelfsense.operators.selection import select_ranks
    r = random.Random(8)
    cols = {"tail": [10.0 ** r.uniform(-30, 30) * r.choice([1, -1]) for _ in range(700)],
            "ties": [float(r.choice([1, 1, 1, 2, 7])) for _ in range(700)], "one": [3.5] * 700,
            "gaps": [r.choice([None, float("nan"), r.gauss(0, 1)]) for _ in range(700)],
            "ends": [r.choice([float("inf"), float("-inf"), 1e308, -1e308, 0.0]) for _ in range(700)]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(4)
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    for ranges in (2, 4096):
        got = {(x["column"], x.prob): x.value for x in select_ranks(df, list(cols)[:4], probs, ranges=ranges).collect()}
        for c, values in list(cols.items())[:4]:
            v = sorted(x for x in values if x is not None and x == x)
            for p in probs:
                pos = p * (len(v) - 1)
                lo = int(pos)
                want = v[lo] if pos == lo else v[lo] + (v[lo + 1] - v[lo]) * (pos - lo)
                assert got[c, p] == pytest.approx(want, rel=1e-12), (c, p)
    whole = select_ranks(df, ["ends"], [0.5], rank_of=lambda n, p: F.floor(n / 2)).first().value
    assert whole == sorted(cols["ends"])[350]


def test_ranks_need_no_window_over_values(spark):
    from shelfsense.operators import selection
    long = selection.to_long(spark.range(1000).select(F.col("id").cast("double").alias("x")), ["x"])
    ranks = selection._ranks(long, ["column"], [0.5], None)
    plan = selection._one_pass(long, ranks, ["column"], True, 64)._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_correlations_of_all_pairs_come_from_one_pass_without_wide_aggregates(spark):
    """Gaps are left out pair by pair, far-off means lose nothing, a constant column has no correlation."""
    import numpy as np
    from shelfsense.operators.stats import correlation_matrix
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    x[:, 1] += 0.5 * x[:, 0]
    x[:, 2] += 1e6
    gaps = x.copy()
    gaps[::7, 0], gaps[::5, 1] = np.nan, np.nan
    rows = [(None if i % 14 == 0 else float(a), float(b), float(c), 4.0) for i, (a, b, c) in enumerate(gaps)]
    df = spark.createDataFrame(rows, "a double, b double, c double, same double").repartition(5)
    out = correlation_matrix(df, ["a", "b", "c", "same"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "corr(" not in plan and "MapInArrow" in plan
    got = {(r.a, r.b): r["corr"] for r in out.collect()}
    assert len(got) == 16
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            both = ~np.isnan(gaps[:, i]) & ~np.isnan(gaps[:, j])
            assert abs(got[p, q] - np.corrcoef(gaps[both, i], gaps[both, j])[0, 1]) < 1e-9
        assert got[p, "same"] is None
    assert correlation_matrix(df.limit(0), ["a", "b"]).filter("corr IS NOT NULL").isEmpty()
