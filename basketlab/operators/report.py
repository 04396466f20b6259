"""Holdings and detail reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.operators.metrics import SUMMARY_COLUMNS


def holdings(summary: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per (basket, member) with a non-zero rounded weight, joined to the company dictionary.

    Members missing from the dictionary drop out (inner join); the dictionary's
    ``symbol`` column is removed, its other columns are appended.
    """
    exploded = summary.select(
        "Names",
        "TotalReturns",
        "InvestmentAmount",
        "Volatility",
        F.inline(F.arrays_zip(F.col("Portfolios").alias("Portfolios"), F.col("Weightage").alias("Weightage"))),
    ).select(SUMMARY_COLUMNS)
    kept = exploded.where(F.col("Weightage") != 0)
    return kept.join(companies, kept["Portfolios"] == companies["symbol"]).drop(companies["symbol"])


def portfolio_detail(holdings_df: DataFrame, stocks: DataFrame, drop: str = "label") -> DataFrame:
    """Holdings joined to the full price history of each held ticker, ``label`` dropped.

    A ticker's history repeats once per basket holding it.
    """
    joined = holdings_df.join(stocks, holdings_df["Portfolios"] == stocks["symbol"])
    return joined.drop(drop) if drop in stocks.columns else joined
