"""Portfolio risk, expected return, summary and volatility label.

Weights are the reported ones (2 decimals, float), so every figure here is an
exact integer combination of rounded inputs until the last step:

* risk ``sqrt(P * w'Sw)`` is the sample standard deviation of the basket's
  return series ``sum_i w_i r_i(d)``, annualised: no pair of members is
  materialised and the work is ``members x dates`` per basket;
* expected return ``P * sum_i w_i mean_i`` (float, 2 decimals);
* investment amount ``sum_i float(w_i) * float(close_i)`` and basket beta
  ``sum_i float(w_i) * float(beta_i)`` (float products, double sum, 2 decimals);
* volatility ``High`` when the rounded basket beta exceeds the threshold, else
  ``Low`` (also when it is null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.functions.numeric import exact, units

# Column names of the original report.
SUMMARY_COLUMNS = ["Names", "Portfolios", "Weightage", "TotalReturns", "InvestmentAmount", "Volatility"]


def portfolio_risk(
    weights: DataFrame,
    returns: DataFrame,
    periods: int = 250,
    weight_decimals: int = 2,
    ret_decimals: int = 6,
) -> DataFrame:
    """``(portfolio, risk)``: annualised standard deviation of the weighted return series."""
    w = weights.select("portfolio", "symbol", units("weight", weight_decimals).alias("wu"))
    r = returns.select("date", "symbol", units("ret", ret_decimals).alias("x"))
    series = (
        w.join(r, "symbol")
        .groupBy("portfolio", "date")
        .agg(F.sum(exact("wu") * F.col("x")).alias("v"))
    )
    g = series.groupBy("portfolio").agg(
        F.count("*").alias("n"), F.sum("v").alias("sv"), F.sum(F.col("v") * F.col("v")).alias("svv")
    )
    n = exact("n")
    var_num = (n * F.col("svv") - F.col("sv") * F.col("sv")).cast("double")
    nn = (F.col("n") * (F.col("n") - 1)).cast("double")
    scale = F.lit(10.0 ** (weight_decimals + ret_decimals))
    risk = F.sqrt(var_num / nn) / scale * F.sqrt(F.lit(float(periods)))
    return g.select("portfolio", F.when(F.col("n") > 1, risk).alias("risk"))


def _total_return_units(weight_decimals: int, mean_decimals: int):
    return F.sum(exact(units("weight", weight_decimals)) * units("mean", mean_decimals))


def portfolio_return(
    weights: DataFrame,
    means: DataFrame,
    periods: int = 250,
    weight_decimals: int = 2,
    mean_decimals: int = 6,
    decimals: int = 2,
) -> DataFrame:
    """``(portfolio, total_return float)``: ``periods * sum(w * mean)`` as float, rounded."""
    g = weights.join(means, "symbol", "left").groupBy("portfolio").agg(
        _total_return_units(weight_decimals, mean_decimals).alias("t")
    )
    return g.select("portfolio", _annual(F.col("t"), periods, weight_decimals + mean_decimals, decimals).alias("total_return"))


def _annual(t, periods: int, scale_decimals: int, decimals: int):
    value = (t * F.lit(periods)).cast("double") / F.lit(10.0**scale_decimals)
    return F.round(value.cast("float"), decimals)


def _weighted_sum(arr_w: str, arr_v: str):
    """``sum(w_i * v_i)`` over two aligned float arrays, in position order, double accumulator."""
    return F.aggregate(
        F.zip_with(arr_w, arr_v, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda acc, v: acc + v
    )


def volatility_label(beta, threshold: float = 1.0):
    return F.when(beta > F.lit(threshold), F.lit("High")).otherwise(F.lit("Low"))


def portfolio_summary(
    weights: DataFrame,
    stats: DataFrame,
    latest: DataFrame,
    periods: int = 250,
    weight_decimals: int = 2,
    mean_decimals: int = 6,
    decimals: int = 2,
    threshold: float = 1.0,
) -> DataFrame:
    """One row per basket: ``Names, Portfolios, Weightage, TotalReturns, InvestmentAmount, Volatility``.

    ``stats`` is ``(symbol, mean, beta)``. Arrays are in position order; every group holds at most ``max_size`` members.
    """
    rows = (
        weights.select("portfolio", "pos", "symbol", "weight")
        .join(stats.select("symbol", "mean", F.col("beta").cast("float").alias("beta")), "symbol", "left")
        .join(latest.select("symbol", F.col("price").cast("float").alias("amount")), "symbol", "left")
    )
    g = rows.groupBy("portfolio").agg(
        F.array_sort(F.collect_list(F.struct("pos", "symbol", "weight", "amount", "beta"))).alias("m"),
        _total_return_units(weight_decimals, mean_decimals).alias("t"),
    )
    s = g.select(
        F.col("portfolio").alias("Names"),
        F.col("m.symbol").alias("Portfolios"),
        F.col("m.weight").alias("Weightage"),
        F.col("m.amount").alias("_amount"),
        F.col("m.beta").alias("_beta"),
        _annual(F.col("t"), periods, weight_decimals + mean_decimals, decimals).alias("TotalReturns"),
    )
    s = s.select(
        "Names",
        "Portfolios",
        "Weightage",
        "TotalReturns",
        F.round(_weighted_sum("Weightage", "_amount"), decimals).alias("InvestmentAmount"),
        F.round(_weighted_sum("Weightage", "_beta"), decimals).alias("PortfolioBeta"),
    )
    return s.withColumn("Volatility", volatility_label(F.col("PortfolioBeta"), threshold)).select(SUMMARY_COLUMNS)
