"""Minimum-variance solver: literal optima, brute force and KKT properties."""

import itertools

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from basketlab.operators.weights import min_variance_qp, min_variance_weights


def brute_force(cov):
    n = cov.shape[0]
    best, best_w = np.inf, None
    for k in range(1, n + 1):
        for sup in itertools.combinations(range(n), k):
            idx = list(sup)
            sub = cov[np.ix_(idx, idx)]
            try:
                x = np.linalg.solve(sub, np.ones(k))
            except np.linalg.LinAlgError:
                continue
            if np.any(x <= 0):
                continue
            w = np.zeros(n)
            w[idx] = x / x.sum()
            v = w @ cov @ w
            if v < best:
                best, best_w = v, w
    return best_w


def test_two_asset_optimum():
    w = min_variance_qp(np.array([[1.0, 0.0], [0.0, 4.0]]))
    assert np.round(w, 2).tolist() == [0.8, 0.2]


def test_corner_optimum():
    w = min_variance_qp(np.array([[1.0, 2.0], [2.0, 9.0]]))
    assert np.round(w, 2).tolist() == [1.0, 0.0]


@given(st.integers(2, 10), st.integers(0, 10**6))
def test_matches_brute_force(n, seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n + 5, n)) * rng.uniform(0.5, 2.0, n)
    cov = np.cov(a, rowvar=False)
    w = min_variance_qp(cov)
    ref = brute_force(cov)
    assert np.all(w >= 0) and abs(w.sum() - 1) < 1e-12
    assert w @ cov @ w <= ref @ cov @ ref * (1 + 1e-9)
    eq = np.full(n, 1 / n)
    assert w @ cov @ w <= eq @ cov @ eq * (1 + 1e-12)
    g = cov @ w
    v = w @ cov @ w
    held = w > 1e-9
    assert np.allclose(g[held], v, rtol=1e-6)
    assert np.all(g[~held] >= v * (1 - 1e-6))


def test_spark_solver_per_basket(spark):
    baskets = spark.createDataFrame(
        [("P1", 0, "A"), ("P1", 1, "B"), ("P2", 0, "A"), ("P2", 1, "C")], "portfolio string, pos int, symbol string"
    )
    cov_rows = [("A", "A", 1.0), ("B", "B", 4.0), ("A", "B", 0.0), ("B", "A", 0.0),
                ("C", "C", 9.0), ("A", "C", 2.0), ("C", "A", 2.0)]
    cov = spark.createDataFrame(cov_rows, "symbol_a string, symbol_b string, cov double")
    w = {(r["portfolio"], r["symbol"]): r["weight"] for r in min_variance_weights(baskets, cov).collect()}
    assert w[("P1", "A")] == pytest.approx(0.8) and w[("P1", "B")] == pytest.approx(0.2)
    assert w[("P2", "A")] == 1.0 and w[("P2", "C")] == 0.0


def test_singular_covariance_twins():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(12, 1))
    series = np.hstack([a, a, rng.normal(size=(12, 1))])  # two identical assets
    cov = np.cov(series, rowvar=False)
    w = min_variance_qp(cov)
    assert np.all(w >= 0) and abs(w.sum() - 1) < 1e-12
    ref = brute_force(cov + np.eye(3) * 1e-9)
    assert w @ cov @ w <= ref @ cov @ ref * (1 + 1e-6)


def test_constant_basket_gets_equal_weights():
    assert np.allclose(min_variance_qp(np.zeros((3, 3))), [1 / 3] * 3)


def test_missing_covariance_is_an_error():
    with pytest.raises(ValueError, match="missing"):
        min_variance_qp(np.array([[1.0, np.nan], [np.nan, 1.0]]))


def test_kkt_check_flags_every_kind_of_bad_weights(spark):
    from basketlab.plans.catalog import analysis, kkt_violations
    from helpers import SF_SMALL
    from pyspark.sql import functions as F

    a = analysis(spark, SF_SMALL, optimal=True)

    def check(w):
        return kkt_violations(w, a.returns, a.baskets).collect()[0].asDict()

    good = check(a.optimal_weights)
    n = a.baskets.count()
    assert good["n_members"] == n and good["n_baskets"] > 0
    assert not any(good[k] for k in ("violations", "negative", "bad_sums", "bad_rounding", "missing", "extra"))
    assert check(a.equal_weights)["violations"] > 0
    empty = check(a.optimal_weights.where("false"))
    assert empty["missing"] == n and empty["n_baskets"] == 0
    one_less = check(a.optimal_weights.where("not (portfolio = 'Portfolio1' and pos = 0)"))
    assert one_less["missing"] == 1
    # a short position with the same sum: optimal without the sign rule, but not allowed
    first = F.col("pos") == 0
    short = a.optimal_weights.withColumn("weight_exact", F.when(first, F.lit(-0.5)).otherwise(F.col("weight_exact")))
    flagged = check(short)
    assert flagged["negative"] > 0 and flagged["bad_sums"] > 0 and flagged["bad_rounding"] > 0


@given(st.integers(3, 10), st.integers(0, 10**6))
def test_rank_deficient_covariance(n, seed):
    """Fewer dates than assets: a singular covariance still gets valid, near-optimal weights."""
    rng = np.random.default_rng(seed)
    k = int(rng.integers(2, n))  # k < n samples -> rank k-1
    cov = np.cov(rng.normal(size=(k, n)), rowvar=False)
    w = min_variance_qp(cov)
    assert np.all(w >= 0) and abs(w.sum() - 1) < 1e-12
    v = w @ cov @ w
    eq = np.full(n, 1 / n)
    assert v <= eq @ cov @ eq + 1e-12
    ref = brute_force(cov)
    if ref is not None:
        assert v <= ref @ cov @ ref + 1e-10 * np.trace(cov)


@given(st.integers(1, 10), st.integers(1, 12), st.integers(0, 10**6))
def test_stack_equals_one_by_one(n, baskets, seed):
    from basketlab.operators.weights import min_variance_batch

    rng = np.random.default_rng(seed)
    covs = []
    for _ in range(baskets):
        x = rng.normal(size=(int(rng.integers(2, n + 6)), n)) * rng.uniform(0.0, 2.0, n)
        covs.append(np.atleast_2d(np.cov(x, rowvar=False)))
    covs[0] = np.zeros((n, n))  # a basket of constant series
    got = min_variance_batch(np.stack(covs))
    assert np.allclose(got, np.stack([min_variance_qp(c) for c in covs]), atol=1e-9)


def test_solver_has_no_python_group_a_basket(spark):
    baskets = spark.createDataFrame([("P1", 0, "A"), ("P1", 1, "B")], "portfolio string, pos int, symbol string")
    cov = spark.createDataFrame([("A", "A", 1.0), ("A", "B", 0.0), ("B", "B", 4.0)], "symbol_a string, symbol_b string, cov double")
    plan = min_variance_weights(baskets, cov)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "FlatMapGroups" not in plan
