"""Correlation, covariance, means, betas, peers and baskets on literal inputs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlab.operators import baskets as B
from basketlab.operators import stats as S
from helpers import day


def returns_df(spark, series, index=None):
    """series: {symbol: [ret, ...]} on consecutive days; index: [ret, ...]."""
    n = len(next(iter(series.values())))
    index = index or [0.001 * (i % 3 - 1) for i in range(n)]
    rows = [(day(i), s, float(v), float(index[i])) for s, vals in series.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "date date, symbol string, ret double, index_ret double")


def test_correlation_matches_numpy(spark, ansi):
    rng = np.random.default_rng(7)
    data = {s: np.round(rng.normal(0, 0.02, 30), 6).tolist() for s in "ABCD"}
    corr = {(r["symbol_a"], r["symbol_b"]): r["corr"] for r in S.correlation_matrix(returns_df(spark, data)).collect()}
    assert len(corr) == 16
    m = np.corrcoef(np.array([data[s] for s in "ABCD"]))
    for i, a in enumerate("ABCD"):
        for j, b in enumerate("ABCD"):
            assert corr[(a, b)] == pytest.approx(round(m[i, j], 2), abs=1e-12)
            assert corr[(a, b)] == corr[(b, a)]


def test_covariance_matches_numpy(spark):
    rng = np.random.default_rng(3)
    data = {s: np.round(rng.normal(0, 0.02, 25), 6).tolist() for s in "XYZ"}
    cov = {(r["symbol_a"], r["symbol_b"]): r["cov"] for r in S.covariance(returns_df(spark, data)).collect()}
    m = np.cov(np.array([data[s] for s in "XYZ"]))
    for i, a in enumerate("XYZ"):
        for j, b in enumerate("XYZ"):
            assert cov[(a, b)] == pytest.approx(m[i, j], rel=1e-12)


def test_constant_series_is_safe(spark, ansi):
    data = {"FLAT": [0.01] * 10, "MOVE": [0.01 * (i % 4) for i in range(10)]}
    r = returns_df(spark, data)
    corr = {(x["symbol_a"], x["symbol_b"]): x["corr"] for x in S.correlation_matrix(r).collect()}
    assert corr[("FLAT", "MOVE")] is None and corr[("FLAT", "FLAT")] is None
    assert corr[("MOVE", "MOVE")] == 1.0
    cov = {(x["symbol_a"], x["symbol_b"]): x["cov"] for x in S.covariance(r).collect()}
    assert cov[("FLAT", "FLAT")] == 0.0 and cov[("FLAT", "MOVE")] == 0.0
    betas = {x["symbol"]: x["beta"] for x in S.betas(r).collect()}
    assert betas["FLAT"] == 0.0


def test_constant_index_gives_beta_zero(spark, ansi):
    r = returns_df(spark, {"A": [0.01, 0.02, -0.01, 0.03]}, index=[0.005] * 4)
    assert S.betas(r).collect()[0]["beta"] == 0.0


def test_beta_is_ols_slope(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(0, 0.01, 40), 6)
    y = np.round(1.3 * x + rng.normal(0, 0.002, 40), 6)
    r = returns_df(spark, {"A": y.tolist()}, index=x.tolist())
    slope = np.polyfit(x, y, 1)[0]
    assert S.betas(r).collect()[0]["beta"] == round(slope, 2)


def test_mean_rounds_half_up_exactly(spark):
    # mean of 0.000001 and 0.000002 is 0.0000015 -> 0.000002 (half up)
    r = returns_df(spark, {"A": [0.000001, 0.000002]})
    assert S.mean_returns(r).collect()[0]["mean"] == 0.000002
    r = returns_df(spark, {"A": [-0.000001, -0.000002]})
    assert S.mean_returns(r).collect()[0]["mean"] == -0.000002


def _corr_frame(spark, pairs):
    return spark.createDataFrame(pairs, "symbol_a string, symbol_b string, corr double")


def test_peers_inclusive_bounds(spark):
    corr = _corr_frame(
        spark,
        [("P1", "S", 0.49), ("P2", "S", 0.50), ("P3", "S", 0.99), ("S", "S", 1.00), ("P5", "S", None)],
    )
    peers = {r["symbol"] for r in B.correlated_peers(corr, 0.5, 0.99).collect()}
    assert peers == {"P2", "P3"}


@pytest.mark.parametrize("n_peers,kept", [(4, False), (5, True), (9, True), (10, False)])
def test_basket_size_rule(spark, n_peers, kept):
    peers = spark.createDataFrame(
        [("S", f"P{i:02d}", 0.7) for i in range(n_peers)], "seed string, symbol string, corr double"
    )
    names = ["S"] + [f"P{i:02d}" for i in range(n_peers)]
    universe = spark.createDataFrame([(s, 0) for s in names], "symbol string, upos int")
    b = B.build_baskets(peers, universe, 6, 10)
    rows = b.orderBy("pos").collect()
    assert bool(rows) == kept
    if kept:
        assert [r["symbol"] for r in rows] == sorted(names[1:]) + ["S"]
        assert {r["portfolio"] for r in rows} == {"Portfolio1"}


def test_portfolio_names_follow_seed_order(spark):
    seeds = ["B", "A", "C"]
    members = {s: [f"{s}{i}" for i in range(6)] for s in seeds}
    peers = spark.createDataFrame(
        [(s, m, 0.8) for s in seeds for m in members[s]], "seed string, symbol string, corr double"
    )
    universe = spark.createDataFrame([(s, i) for i, s in enumerate(seeds)], "symbol string, upos int")
    b = B.build_baskets(peers, universe, 6, 10)
    last = {r["portfolio"]: r["symbol"] for r in b.where("pos = 6").collect()}
    assert last == {"Portfolio1": "B", "Portfolio2": "A", "Portfolio3": "C"}


def test_equal_weights_round_half_even(spark):
    b = spark.createDataFrame([("P", i, f"S{i}") for i in range(8)], "portfolio string, pos int, symbol string")
    w = B.equal_weights(b).collect()
    assert all(r["weight"] == pytest.approx(0.12) for r in w) and len(w) == 8
    assert all(r["weight_exact"] == 0.125 for r in w)


def _random_returns(spark, seed, symbols="ABCDEFG", days=15):
    rng = np.random.default_rng(seed)
    rows = [(day(i), s, float(np.round(rng.normal(0, 0.05), 6)), 0.0) for s in symbols for i in range(days)]
    return spark.createDataFrame(rows, "date date, symbol string, ret double, index_ret double")


@pytest.mark.parametrize("parallelism, day_span", [(1, 4), (3, 7), (8, 1024), (100, 1)])
def test_blocked_moments_equal_join(spark, parallelism, day_span):
    r = _random_returns(spark, parallelism)
    a = sorted(tuple(x) for x in S.pair_moments(r, method="join").collect())
    b = sorted(tuple(x) for x in S.pair_moments(r, parallelism=parallelism, day_span=day_span).collect())
    assert a == b and len(a) == 28


def test_uneven_dates_are_an_error(spark):
    r = _random_returns(spark, 1)
    with pytest.raises(Exception, match="complete-case"):
        S.pair_moments(r.where("not (symbol = 'A' and date = '2024-01-03')")).collect()


def test_pair_work_is_split_by_block_and_date_range(spark):
    units = S._units_frame(_random_returns(spark, 2), 6, None)
    groups = S.pair_groups(units, parallelism=4, day_span=5).select("blk_lo", "blk_hi", "span").distinct().collect()
    assert len({(g.blk_lo, g.blk_hi) for g in groups}) >= 4 and len({g.span for g in groups}) >= 3


def _history(spark, days, symbols=4, top=2**40, sign=0, seed=0):
    """Returns whose units are whole numbers up to ``top`` (``sign`` -1: all negative)."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-top, top, size=(days, symbols), endpoint=True)
    x = -np.abs(x) if sign < 0 else x
    rows = [(day(i), f"S{j}", float(x[i, j]), 0.0) for j in range(symbols) for i in range(days)]
    return spark.createDataFrame(rows, "date date, symbol string, ret double, index_ret double"), x


@pytest.mark.parametrize("top, sign", [(20, 0), (10**6, -1), (2**40, 0), (2**40, -1)])
@pytest.mark.parametrize("days", [1, 60, 120, 1100])
def test_pair_sums_are_exact_for_any_history(spark, ansi, days, top, sign):
    r, x = _history(spark, days, top=top, sign=sign)
    want = sorted(tuple(v) for v in S.pair_moments(r, 0, method="join").collect())
    got = sorted(tuple(v) for v in S.pair_moments(r, 0, parallelism=2).collect())
    assert got == want and len(got) == 10
    for a, b, n, cov, *_ in got:
        u, v = ([int(k) for k in x[:, int(s[1:])]] for s in (a, b))
        assert n == days and int(cov) == days * sum(p * q for p, q in zip(u, v)) - sum(u) * sum(v)


def test_sums_beyond_38_digits_are_an_error(spark, ansi):
    rows = [(day(i), s, 2.0**61, 0.0) for s in "AB" for i in range(400)]
    r = spark.createDataFrame(rows, "date date, symbol string, ret double, index_ret double")
    with pytest.raises(Exception, match="122 bits|38,0|verflow|OUT_OF_RANGE"):
        S.pair_moments(r, 0).collect()


@pytest.mark.parametrize("days", [2, 40, 300, 1500])
@pytest.mark.parametrize("lo, hi", [(0.5, 0.99), (-0.2, 0.1), (-1.0, 1.0), (1.0, 1.0), (0.9, 0.2)])
def test_pruned_correlations_equal_the_filtered_matrix(spark, days, lo, hi):
    rng = np.random.default_rng(days)
    common = rng.normal(0, 0.02, (days, 3))
    x = np.round(np.stack([common[:, j % 3] * (j % 4) / 2 + rng.normal(0, 0.01, days) for j in range(11)] + [np.full(days, 0.01)], axis=1), 6)
    rows = [(day(i), f"S{j}", float(x[i, j]), 0.0) for j in range(x.shape[1]) for i in range(days)]
    r = spark.createDataFrame(rows, "date date, symbol string, ret double, index_ret double")
    want = sorted(tuple(v) for v in S.correlation_half(r).where(F.col("corr").between(lo, hi)).collect())
    assert sorted(tuple(v) for v in S.correlation_half_in_range(r, lo, hi, parallelism=3).collect()) == want


def test_pairs_out_of_range_never_leave_their_group(spark):
    r = _random_returns(spark, 4, symbols=[f"S{j:02d}" for j in range(60)], days=400)
    units = S._units_frame(r, 6, None)
    assert S._product_sums_in_range(units, 0.495, 0.995, 2).count() == 0  # of 1,830 pairs
    assert S._product_sums_in_range(units, 0.495, 1.005, 2).count() == 60  # the diagonal


def test_pruning_refuses_uneven_dates(spark):
    r = _random_returns(spark, 1).where("not (symbol = 'A' and date = '2024-01-03')")
    with pytest.raises(Exception, match="complete-case"):
        S.correlation_half_in_range(r, 0.5, 0.99, parallelism=1).collect()


def test_listed_covariances_equal_the_matrix_and_take_no_other_pair(spark):
    r, _ = _history(spark, 1100, symbols=7, top=10**5)
    listed = [("S0", "S1"), ("S0", "S0"), ("S3", "S6"), ("S0", "S1"), ("S2", "S9")]
    pairs = spark.createDataFrame(listed, "symbol_a string, symbol_b string")
    want = {(v.symbol_a, v.symbol_b): v.cov for v in S.covariance(r, 0).collect()}
    got = {(v.symbol_a, v.symbol_b): v.cov for v in S.pair_covariance(r, pairs, 0).collect()}
    assert got == {p: want[p] for p in listed if p in want} and len(got) == 3
    assert S._product_sums_listed(S._units_frame(r, 0, None), pairs, 4).count() == 3


@pytest.mark.parametrize("top", [10, 10**6, 2**40, 2**52])
def test_limb_products_are_exact(top):
    import pandas as pd

    x = np.random.default_rng(0).integers(-top, top, size=(30, 3))
    pdf = pd.DataFrame({"blk_lo": 0, "blk_hi": 0, "blk": 0, "symbol": ["S0", "S1", "S2"], "days": [np.arange(30)] * 3, "xs": [x[:, j] for j in range(3)]})
    for _, r in S._block_pair_sums(pdf).iterrows():
        i, j = int(r["symbol_a"][1:]), int(r["symbol_b"][1:])
        assert int(r["hi"]) * 2**60 + int(r["lo"]) == sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j]))


def test_member_stats_equal_separate_operators(spark):
    rng = np.random.default_rng(9)
    data = {s: np.round(rng.normal(0, 0.02, 12), 6).tolist() for s in "ABCD"}
    r = returns_df(spark, data, index=np.round(rng.normal(0, 0.01, 12), 6).tolist())
    both = {x["symbol"]: (x["mean"], x["beta"]) for x in S.member_stats(r).collect()}
    means = {x["symbol"]: x["mean"] for x in S.mean_returns(r).collect()}
    betas = {x["symbol"]: x["beta"] for x in S.betas(r).collect()}
    assert both == {s: (means[s], betas[s]) for s in "ABCD"}
