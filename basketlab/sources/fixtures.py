"""Inputs of the portfolio pipeline, derived by Spark from the TPC-H-style tables.

Symbol = part brand, date = first day of the ship quarter, price = the exact
volume-weighted price of the brand in that quarter, market index = the same
over all brands. Everything grows with ``lineitem``: the scan reads four
columns, the join with ``part`` is left to AQE (broadcast when ``part`` is
measured small, shuffled otherwise, skewed part keys split by the skew-join
rule) and the aggregation combines map-side before its small shuffle.

Notional and quantity are summed as integer cents, so the prices do not depend
on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(col: str):
    return F.round(F.col(col) * F.lit(100.0)).cast("bigint")


# Ticker definitions over ``part``: the brand (25 tickers), the type (6 tickers,
# which trade every day), or brand and size (about 1,250 tickers) for a wider
# universe from the same tables.
SYMBOLS = {
    "type": lambda: F.col("p_type"),
    "brand": lambda: F.col("p_brand"),
    "brand_size": lambda: F.concat(F.col("p_brand"), F.lit("/"), F.col("p_size").cast("string")),
}


def trades(spark: SparkSession, sf_dir: str, symbol: str = "brand", period: str = "quarter") -> DataFrame:
    """One row per line item: ``(date date, symbol string, e_cents long, q_cents long)``."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type")
    return li.join(pt, li.l_partkey == pt.p_partkey).select(
        F.date_trunc(period, F.col("l_shipdate").cast("date")).cast("date").alias("date"),
        SYMBOLS[symbol]().alias("symbol"),
        _cents("l_extendedprice").alias("e_cents"),
        _cents("l_quantity").alias("q_cents"),
    )


def _vwap(e: str, q: str):
    return F.try_divide(F.col(e).cast("double") / F.lit(100.0), F.col(q).cast("double") / F.lit(100.0))


def brand_sums(spark: SparkSession, sf_dir: str, symbol: str = "brand", period: str = "quarter") -> DataFrame:
    """``(date, symbol, e, q)``: notional and quantity cents per (period, ticker).

    The single aggregation both the stocks table and the index derive from
    (integer sums regroup exactly, so the index needs no second scan).
    """
    return trades(spark, sf_dir, symbol, period).groupBy("date", "symbol").agg(
        F.sum("e_cents").alias("e"), F.sum("q_cents").alias("q")
    )


def stocks_from_sums(sums: DataFrame) -> DataFrame:
    """The flat stocks table: ``symbol, date 'yyyy-MM-dd', adjClose, label``."""
    d = F.date_format("date", "yyyy-MM-dd")
    return sums.select(
        "symbol",
        d.alias("date"),
        _vwap("e", "q").alias("adjClose"),
        F.concat(F.col("symbol"), F.lit(" "), d).alias("label"),
    )


def index_from_sums(sums: DataFrame) -> DataFrame:
    """Index file as text columns, as a CSV read without schema gives them: ``Date, Close``."""
    t = sums.groupBy("date").agg(F.sum("e").alias("e"), F.sum("q").alias("q"))
    return t.select(
        F.date_format("date", "MM/dd/yyyy").alias("Date"),
        _vwap("e", "q").cast("string").alias("Close"),
    )


def stocks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stocks_from_sums(brand_sums(spark, sf_dir))


def index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_from_sums(brand_sums(spark, sf_dir))


def price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested document per ticker: ``symbol, historical array<struct<date, adjClose, label>>``.

    A document holds one record per quarter of its ticker, so its size is bounded
    by the calendar, not by the data volume.
    """
    st = stocks_table(spark, sf_dir)
    return st.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("date", "adjClose", "label"))).alias("historical")
    )


def companies(spark: SparkSession, sf_dir: str, symbol: str = "brand") -> DataFrame:
    """Company dictionary ``symbol, company_name``: every ticker."""
    tickers = read_table(spark, sf_dir, "part").select(SYMBOLS[symbol]().alias("symbol")).distinct()
    return tickers.select("symbol", F.concat(F.lit("Company "), F.col("symbol")).alias("company_name"))
