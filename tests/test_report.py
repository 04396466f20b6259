"""Summary figures, volatility label, holdings and detail."""

import pytest
from pyspark.sql import functions as F

from basketlab.operators import metrics as M
from basketlab.operators import report as R


def test_float_dot_product(spark):
    df = spark.createDataFrame([([0.1, 0.2], [100.1, 33.3])], "w array<float>, a array<float>")
    v = df.select(M._weighted_sum("w", "a").alias("v")).collect()[0]["v"]
    assert v == 16.670000076293945


@pytest.mark.parametrize("beta,label", [(1.00, "Low"), (1.01, "High"), (None, "Low")])
def test_volatility_label(spark, beta, label):
    df = spark.createDataFrame([(beta,)], "b double")
    assert df.select(M.volatility_label(F.col("b")).alias("v")).collect()[0]["v"] == label


def _summary_inputs(spark, weights):
    w = spark.createDataFrame(
        [("Portfolio1", i, s, float(x), x) for i, (s, x) in enumerate(weights)],
        "portfolio string, pos int, symbol string, weight_exact double, weight float",
    )
    syms = [s for s, _ in weights]
    means = spark.createDataFrame([(s, 0.001) for s in syms], "symbol string, mean double")
    latest = spark.createDataFrame([(s, 10.0) for s in syms], "symbol string, price double")
    betas = spark.createDataFrame([(s, 1.2) for s in syms], "symbol string, beta double")
    return w, means, latest, betas


def test_summary_and_zero_weight_removed(spark):
    w, means, latest, betas = _summary_inputs(spark, [("A", 0.5), ("B", 0.5), ("C", 0.0)])
    s = M.portfolio_summary(w, means.join(betas, "symbol"), latest)
    row = s.collect()[0]
    assert row["Portfolios"] == ["A", "B", "C"]
    assert row["TotalReturns"] == pytest.approx(0.25)
    assert row["InvestmentAmount"] == 10.0
    assert row["Volatility"] == "High"
    companies = spark.createDataFrame([("A", "Alpha"), ("C", "Gamma")], "symbol string, company_name string")
    h = R.holdings(s, companies)
    assert h.columns == ["Names", "Portfolios", "Weightage", "TotalReturns", "InvestmentAmount", "Volatility", "company_name"]
    assert [r["Portfolios"] for r in h.collect()] == ["A"]  # B has no company, C has weight 0


def test_missing_latest_price_gives_null_amount(spark):
    w, means, latest, betas = _summary_inputs(spark, [("A", 0.5), ("B", 0.5)])
    latest = latest.where("symbol = 'A'")
    assert M.portfolio_summary(w, means.join(betas, "symbol"), latest).collect()[0]["InvestmentAmount"] is None


def test_detail_repeats_history_and_drops_label(spark):
    w, means, latest, betas = _summary_inputs(spark, [("A", 0.5), ("B", 0.5)])
    s = M.portfolio_summary(w, means.join(betas, "symbol"), latest)
    companies = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "symbol string, company_name string")
    h = R.holdings(s, companies)
    stocks = spark.createDataFrame(
        [("A", "2024-01-01", 1.0, "x"), ("A", "2024-01-02", 2.0, "y"), ("B", "2024-01-01", 3.0, "z")],
        "symbol string, date string, adjClose double, label string",
    )
    d = R.portfolio_detail(h, stocks)
    assert "label" not in d.columns and "symbol" in d.columns
    assert d.count() == 3


def test_empty_baskets_give_empty_outputs(spark):
    w, means, latest, betas = _summary_inputs(spark, [("A", 0.5)])
    w = w.where("false")
    s = M.portfolio_summary(w, means.join(betas, "symbol"), latest)
    assert s.count() == 0
    assert s.columns == M.SUMMARY_COLUMNS
    assert dict(s.dtypes)["Weightage"] == "array<float>"


def test_equal_weight_risk_matches_quadratic_form(spark):
    import numpy as np

    from helpers import day

    rng = np.random.default_rng(5)
    data = {s: np.round(rng.normal(0, 0.02, 20), 6) for s in "AB"}
    rows = [(day(i), s, float(v), 0.0) for s, vals in data.items() for i, v in enumerate(vals)]
    ret = spark.createDataFrame(rows, "date date, symbol string, ret double, index_ret double")
    w = spark.createDataFrame(
        [("P", 0, "A", 0.3, 0.3), ("P", 1, "B", 0.7, 0.7)],
        "portfolio string, pos int, symbol string, weight_exact double, weight float",
    )
    risk = M.portfolio_risk(w, ret).collect()[0]["risk"]
    wv = np.array([0.3, 0.7])
    cov = np.cov(np.array([data["A"], data["B"]]))
    assert risk == pytest.approx(np.sqrt(wv @ cov @ wv) * np.sqrt(250), rel=1e-12)
