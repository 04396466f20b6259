"""Price panel, calendar, aligned returns and latest close.

The panel is kept long, ``(date, symbol, price)``; the wide one-column-per-
ticker layout is only a view (:func:`pivot_panel`). Returns follow the
original batch exactly:

* the calendar is the set of dates present both in the stocks table (any
  ticker) and in the index; the one-step lag runs over that calendar, not over
  a ticker's own rows;
* ``ret = coalesce(p - prev, 0) / prev`` rounded: a missing price today gives
  0, a missing or zero price yesterday gives null;
* a date survives only if every universe ticker and the index have a non-null
  return on it (complete case).

No calendar x universe grid is built. A return on date ``d`` exists exactly
when the ticker has a price on the calendar predecessor of ``d``, so one
``lead`` over each ticker's own rows gives every cell (the price is missing if
the ticker's next row is not on the next calendar date), and the complete-case
test is a count per date, combined map-side, and a semi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlab.functions.numeric import simple_return
from basketlab.sources.prices import parse_price_dates


def price_panel(stocks: DataFrame, pattern: str = "yyyy-MM-dd") -> DataFrame:
    """``(date date, symbol string, price double)``; duplicate quotes are summed.

    Every ticker of the input is kept: the calendar depends on all of them.
    Rows without a ticker or with an unparseable date belong to no column of
    the original pivot and are dropped.
    The aggregation combines map-side, so a hot (date, symbol) costs one row
    per task before the shuffle.
    """
    s = parse_price_dates(stocks.select("symbol", "date", "adjClose"), pattern)
    return (
        s.where(F.col("date").isNotNull() & F.col("symbol").isNotNull())
        .groupBy("date", "symbol")
        .agg(F.sum(F.col("adjClose").cast("double")).alias("price"))
    )


def pivot_panel(panel: DataFrame, symbols: Sequence[str], value: str = "price") -> DataFrame:
    """Wide view: ``date`` plus one column per listed ticker (only for display or export)."""
    return panel.groupBy("date").pivot("symbol", list(symbols)).agg(F.sum(value))


def universe_frame(panel: DataFrame, universe: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """``(symbol, upos)``: the tickers of the analysis and their seed order.

    ``None`` takes every ticker present in the panel, ordered by symbol; a
    list keeps its own order (repeats count once); a DataFrame must carry
    ``symbol`` and ``upos`` itself.
    """
    if universe is None:
        return panel.select("symbol").distinct().withColumn("upos", F.lit(0))
    if isinstance(universe, DataFrame):
        return universe.select("symbol", F.col("upos").cast("int").alias("upos"))
    spark = panel.sparkSession
    listed = _distinct_in_order(universe)
    return spark.createDataFrame([(s, i) for i, s in enumerate(listed)], "symbol string, upos int")


def _distinct_in_order(universe: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(universe))


def universe_size(universe_df: DataFrame, universe: Sequence[str] | DataFrame | None = None) -> Column:
    if universe is not None and not isinstance(universe, DataFrame):
        return F.lit(len(_distinct_in_order(universe)))
    return universe_df.select(F.countDistinct("symbol")).scalar()


def calendar(panel: DataFrame, index: DataFrame) -> DataFrame:
    """``(date, next_date)`` over dates present in both panel and index.

    The ordering pass runs over distinct trading dates only (one row per day,
    independent of the number of tickers and of the data volume).
    """
    dates = panel.select("date").distinct().join(index.select("date").distinct(), "date")
    return dates.withColumn("next_date", F.lead("date").over(Window.orderBy("date")))


def _in_universe(panel: DataFrame, universe, universe_df: DataFrame) -> DataFrame:
    if universe is None:
        return panel
    return panel.join(universe_df.select("symbol").distinct(), "symbol", "left_semi")


def return_cells(panel: DataFrame, cal: DataFrame, decimals: int = 6) -> DataFrame:
    """``(date, symbol, ret)`` for every ticker that has a price on the previous calendar date."""
    on = panel.join(cal, "date")
    w = Window.partitionBy("symbol").orderBy("date")
    nxt = F.when(F.lead("date").over(w) == F.col("next_date"), F.lead("price").over(w))
    return on.select("next_date", "symbol", "price", nxt.alias("_next")).where(F.col("next_date").isNotNull()).select(
        F.col("next_date").alias("date"), "symbol", F.round(simple_return(F.col("_next"), F.col("price")), decimals).alias("ret")
    )


def index_returns(index: DataFrame, cal: DataFrame, decimals: int = 6) -> DataFrame:
    """``(date, index_ret)`` of the market index over the calendar."""
    prev = index.join(cal.where(F.col("next_date").isNotNull()), "date").select(
        F.col("next_date").alias("date"), F.col("level").alias("prev_level")
    )
    return prev.join(index.select("date", "level"), "date").select(
        "date", F.round(simple_return(F.col("level"), F.col("prev_level")), decimals).alias("index_ret")
    )


def aligned_returns(
    panel: DataFrame,
    index: DataFrame,
    universe: Sequence[str] | DataFrame | None = None,
    decimals: int = 6,
) -> DataFrame:
    """``(date, symbol, ret, index_ret)`` on complete-case dates, universe tickers only."""
    cal = calendar(panel, index)
    udf_ = universe_frame(panel, universe)
    n_u = universe_size(udf_, universe)
    cells = return_cells(_in_universe(panel, universe, udf_), cal, decimals)
    # complete case: every universe ticker has a non-null return on the date
    full = cells.groupBy("date").agg(F.count("ret").alias("n_ok")).where(F.col("n_ok") == n_u)
    complete = cells.join(full, "date", "left_semi")
    idx = index_returns(index, cal, decimals).where(F.col("index_ret").isNotNull())
    return complete.join(idx, "date").select("date", "symbol", "ret", "index_ret")


def dropped_dates(panel: DataFrame, index: DataFrame, returns: DataFrame) -> DataFrame:
    """Calendar dates removed by the complete-case rule (the first date always is)."""
    cal = calendar(panel, index).select("date")
    return cal.join(returns.select("date").distinct(), "date", "left_anti")


def returns_wide(returns: DataFrame, symbols: Sequence[str], index_name: str = "SP500") -> DataFrame:
    """Wide view of the returns: ``date``, one column per ticker, and the index column."""
    wide = pivot_panel(returns, symbols, value="ret")
    idx = returns.select("date", F.col("index_ret").alias(index_name)).distinct()
    return wide.join(idx, "date")


def latest_close(panel: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """``(symbol, date, price)`` on the latest date of the stocks panel (any ticker).

    A ticker without a quote on that date gets no row, so its investment
    amount is null downstream.
    """
    last = panel.select(F.max("date")).scalar()
    out = panel.where(F.col("date") == last).select("symbol", "date", "price")
    if symbols is not None:
        out = out.join(symbols.select("symbol"), "symbol", "left_semi")
    return out
