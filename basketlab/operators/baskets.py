"""Correlated peers, baskets, basket universe and equal weights.

A basket is seeded by every universe ticker: its peers are the tickers whose
rounded correlation with the seed lies in ``[lo, hi]`` (the seed's own 1.00
normally falls out), the seed is appended last, and the basket is kept when
``min_size <= members <= max_size``. Baskets are named ``Portfolio1..k`` in
seed order and are not de-duplicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlab.operators.stats import mirror
from basketlab.session import materialize


def correlated_peers(corr: DataFrame, lo: float = 0.5, hi: float = 0.99) -> DataFrame:
    """``(seed, symbol, corr)`` with ``lo <= corr <= hi`` (a null correlation never qualifies)."""
    return corr.where(F.col("corr").between(lo, hi)).select(
        F.col("symbol_b").alias("seed"), F.col("symbol_a").alias("symbol"), "corr"
    )


def peers_of_half(half: DataFrame, lo: float = 0.5, hi: float = 0.99) -> DataFrame:
    """The same from the ``symbol_a <= symbol_b`` half: the test is symmetric, so only pairs that pass are mirrored."""
    return correlated_peers(mirror(half.where(F.col("corr").between(lo, hi)), "corr"), lo, hi)


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``number`` 1..n in the given order, without one task holding all rows.

    Rows are range-partitioned once (written, so the ranges are fixed), ranked
    within their range, and shifted by the sizes of the ranges before.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # one row per range
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_rank", rank).join(before, "_range").withColumn("number", F.col("_rank") + F.col("_before")).drop("_range", "_rank", "_before")


def build_baskets(
    peers: DataFrame, universe: DataFrame, min_size: int = 6, max_size: int = 10
) -> DataFrame:
    """``(portfolio, pos, symbol)``: peers in universe order, the seed at the last position."""
    counts = peers.groupBy("seed").agg(F.count("*").alias("n_peers"))
    seeds = (
        universe.select(F.col("symbol").alias("seed"), F.col("upos").alias("seed_upos"))
        .join(counts, "seed", "left")
        .withColumn("n", F.coalesce(F.col("n_peers"), F.lit(0)) + 1)
        .where((F.col("n") >= min_size) & (F.col("n") <= max_size))
    )
    named = numbered(seeds, "seed_upos", "seed").select(
        "seed", F.concat(F.lit("Portfolio"), F.col("number").cast("string")).alias("portfolio"), "n"
    )
    members = (
        peers.join(named, "seed")
        .join(universe.select("symbol", "upos"), "symbol", "left")
        .withColumn(
            "pos",
            F.row_number().over(Window.partitionBy("portfolio").orderBy("upos", "symbol")) - 1,
        )
        .select("portfolio", F.col("pos").cast("int").alias("pos"), "symbol")
    )
    seed_rows = named.select("portfolio", (F.col("n") - 1).cast("int").alias("pos"), F.col("seed").alias("symbol"))
    return members.unionByName(seed_rows)


def basket_universe(baskets: DataFrame) -> DataFrame:
    """Distinct tickers held by any basket."""
    return baskets.select("symbol").distinct()


def equal_weights(baskets: DataFrame, decimals: int = 2) -> DataFrame:
    """``(portfolio, pos, symbol, weight_exact, weight)`` with ``1/n`` each (the solver's start point)."""
    n = F.count("*").over(Window.partitionBy("portfolio"))
    w = F.lit(1.0) / n
    return baskets.select(
        "portfolio", "pos", "symbol", w.alias("weight_exact"), F.bround(w, decimals).cast("float").alias("weight")
    )


def basket_arrays(baskets: DataFrame) -> DataFrame:
    """``(portfolio, members array<string>)`` in position order."""
    return baskets.groupBy("portfolio").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda x: x["symbol"]).alias(
            "members"
        )
    )
