"""Property tests: aligned returns against a brute-force wide computation, invariances."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import given
from hypothesis import strategies as st

from basketlab.operators import baskets as B
from basketlab.operators import panel as P
from basketlab.operators import stats as S
from helpers import day


def spark_round(x, d):
    """Spark round(double): half-up on the shortest decimal text."""
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(float(x))).quantize(Decimal(1).scaleb(-d), rounding=ROUND_HALF_UP))


def brute_force_returns(rows, index_levels, decimals=6):
    """The original wide method: pivot-sum, join index, lag over dates, rules, dropna."""
    df = pd.DataFrame(rows, columns=["symbol", "i", "price"])
    wide = df.pivot_table(index="i", columns="symbol", values="price", aggfunc=lambda s: s.sum(min_count=1), dropna=False)
    wide = wide.reindex(sorted(set(df["i"])))
    idx = pd.Series(index_levels, name="SP500")
    wide = wide.join(idx, how="inner").sort_index()
    out = {}
    cols = list(wide.columns)
    for c in cols:
        p = wide[c].to_numpy(dtype=float)
        res = [None]
        for k in range(1, len(p)):
            prev, cur = p[k - 1], p[k]
            if np.isnan(prev) or prev == 0:
                res.append(None)
                continue
            diff = 0.0 if np.isnan(cur) else cur - prev
            res.append(spark_round(diff / prev, decimals))
        out[c] = res
    frame = pd.DataFrame(out, index=wide.index)
    frame = frame.dropna()
    result = set()
    for i, r in frame.iterrows():
        for c in cols:
            if c != "SP500":
                result.add((day(int(i)), c, float(r[c]), float(r["SP500"])))
    return result


cell = st.one_of(st.none(), st.just(0.0), st.floats(1.0, 50.0).map(lambda v: round(v, 2)))


@given(
    data=st.lists(st.lists(st.one_of(st.just("absent"), cell), min_size=8, max_size=8), min_size=1, max_size=4),
    index_missing=st.sets(st.integers(0, 7), max_size=2),
)
def test_aligned_returns_match_wide_method(spark, data, index_missing):
    rows = []
    for s, series in zip("ABCD", data):
        for i, v in enumerate(series):
            if v != "absent":
                rows.append((s, i, v))
    if not rows:
        return
    levels = {i: 100.0 + 3 * i for i in range(8) if i not in index_missing}
    stocks = spark.createDataFrame(
        [(s, day(i).isoformat(), p) for s, i, p in rows], "symbol string, date string, adjClose double"
    )
    idx = spark.createDataFrame([(day(i), v) for i, v in levels.items()], "date date, level double")
    got = {tuple(r) for r in P.aligned_returns(P.price_panel(stocks), idx).collect()}
    assert got == brute_force_returns(rows, levels)


def test_invariant_to_partitioning_and_row_order(spark):
    rng = np.random.default_rng(1)
    rows = [(day(i), s, float(np.round(rng.normal(0, 0.03), 6)), float(np.round(rng.normal(0, 0.01), 6)))
            for s in "ABCDEF" for i in range(20)]
    base = spark.createDataFrame(rows, "date date, symbol string, ret double, index_ret double")
    shuffled = spark.createDataFrame(list(reversed(rows)), base.schema).repartition(7)
    one = base.coalesce(1)
    for f in (S.correlation_matrix, S.covariance, S.mean_returns, S.betas):
        ref = sorted(tuple(r) for r in f(one).collect())
        assert sorted(tuple(r) for r in f(shuffled).collect()) == ref


def test_universe_list_keeps_only_listed_tickers(spark):
    from helpers import index_df, stocks_df

    rows = [(s, i, 10 + i + k) for k, s in enumerate("ABC") for i in range(5)]
    panel = P.price_panel(stocks_df(spark, rows))
    ret = P.aligned_returns(panel, index_df(spark, {i: 100 + i for i in range(5)}), universe=["C", "A"])
    assert {r["symbol"] for r in ret.collect()} == {"A", "C"}


def test_identical_baskets_are_not_deduplicated(spark):
    names = [f"S{i}" for i in range(6)]
    pairs = [(a, b, 0.8) for a in names for b in names if a != b]
    peers = spark.createDataFrame(pairs, "seed string, symbol string, corr double")
    universe = spark.createDataFrame([(s, i) for i, s in enumerate(names)], "symbol string, upos int")
    b = B.build_baskets(peers, universe, 6, 10)
    assert b.select("portfolio").distinct().count() == 6
    assert b.count() == 36


@given(
    quotes=st.lists(
        st.tuples(st.sampled_from("ABC"), st.integers(0, 6), st.one_of(st.none(), st.integers(0, 40).map(float))),
        min_size=1,
        max_size=30,
    ),
    index_zero=st.sets(st.integers(0, 6), max_size=1),
)
def test_duplicates_and_zero_index_match_wide_method(spark, quotes, index_zero):
    levels = {i: (0.0 if i in index_zero else 100.0 + 7 * i) for i in range(7)}
    stocks = spark.createDataFrame(
        [(s, day(i).isoformat(), p) for s, i, p in quotes], "symbol string, date string, adjClose double"
    )
    idx = spark.createDataFrame([(day(i), v) for i, v in levels.items()], "date date, level double")
    got = {tuple(r) for r in P.aligned_returns(P.price_panel(stocks), idx).collect()}
    assert got == brute_force_returns(quotes, levels)
