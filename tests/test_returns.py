"""Return rules, calendar alignment and the complete-case filter."""

import pytest
from pyspark.sql import functions as F

from basketlab.operators import panel as P
from helpers import day, index_df, stocks_df, by_date

PRICES = [11, 12, None, 14, 15, 0, 17, 18, 19]
EXPECTED = [None, 0.090909, 0.0, None, 0.071429, -1.0, None, 0.058824, 0.055556]


def _index(n):
    return {i: 100.0 + i for i in range(n)}


@pytest.mark.parametrize("null_as_row", [True, False])
def test_return_rules(spark, ansi, null_as_row):
    rows = [("A", i, p) for i, p in enumerate(PRICES) if p is not None or null_as_row]
    # B quotes every day, so the calendar holds A's missing day either way
    rows += [("B", i, 50) for i in range(len(PRICES))]
    panel = P.price_panel(stocks_df(spark, rows))
    idx = index_df(spark, _index(len(PRICES)))
    cal = P.calendar(panel, idx)
    got = by_date(P.return_cells(panel, cal), symbol="A")
    for i, exp in enumerate(EXPECTED):
        if i == 0:
            assert day(0) not in got
            continue
        if exp is None:
            assert got.get(day(i)) is None
        else:
            assert got[day(i)] == pytest.approx(exp, abs=0)


def test_complete_case_drops_dates_for_everyone(spark, ansi):
    rows = [("A", i, p) for i, p in enumerate(PRICES)] + [("B", i, 10 + i) for i in range(len(PRICES))]
    panel = P.price_panel(stocks_df(spark, [r for r in rows if r[2] is not None]))
    ret = P.aligned_returns(panel, index_df(spark, _index(len(PRICES))))
    dates = sorted({r["date"] for r in ret.collect()})
    keep = [day(i) for i, e in enumerate(EXPECTED) if e is not None]
    assert dates == keep
    # every surviving date holds both tickers
    assert ret.groupBy("date").count().where("count <> 2").count() == 0


def test_day_without_any_quote_is_not_in_calendar(spark):
    rows = [("A", 0, 11), ("A", 1, 12), ("A", 3, 14)]
    panel = P.price_panel(stocks_df(spark, rows))
    got = by_date(P.return_cells(panel, P.calendar(panel, index_df(spark, _index(4)))))
    assert got[day(3)] == pytest.approx(round(2 / 12, 6), abs=0)


def test_late_listing_truncates_everyone(spark):
    rows = [("A", i, 10 + i) for i in range(10)] + [("B", i, 5 + i) for i in range(4, 10)]
    panel = P.price_panel(stocks_df(spark, rows))
    ret = P.aligned_returns(panel, index_df(spark, _index(10)))
    assert min(r["date"] for r in ret.collect()) == day(5)


def test_universe_ticker_without_data_empties_panel(spark):
    rows = [("A", i, 10 + i) for i in range(5)]
    panel = P.price_panel(stocks_df(spark, rows))
    ret = P.aligned_returns(panel, index_df(spark, _index(5)), universe=["A", "ZZZ"])
    assert ret.count() == 0
    assert P.aligned_returns(panel, index_df(spark, _index(5)), universe=["A"]).count() == 4


def test_duplicate_quotes_are_summed(spark):
    panel = P.price_panel(stocks_df(spark, [("A", 0, 1.0), ("A", 0, 2.0)]))
    assert panel.collect()[0]["price"] == 3.0


def test_calendar_is_intersection_and_latest_close_uses_stock_dates(spark):
    rows = [("A", i, 10 + i) for i in range(6)]
    panel = P.price_panel(stocks_df(spark, rows))
    idx = index_df(spark, {i: 100 + i for i in range(5)})  # day 5 missing from the index
    ret = P.aligned_returns(panel, idx)
    assert day(5) not in {r["date"] for r in ret.collect()}
    latest = P.latest_close(panel).collect()
    assert latest[0]["date"] == day(5) and latest[0]["price"] == 15.0


def test_lag_runs_over_calendar_not_own_rows(spark):
    # B has no row on day 2 but A does: B's day-2 return is 0 and its day-3 return is null.
    rows = [("A", i, 10 + i) for i in range(5)] + [("B", i, 20 + i) for i in (0, 1, 3, 4)]
    panel = P.price_panel(stocks_df(spark, rows))
    cells = P.return_cells(panel, P.calendar(panel, index_df(spark, _index(5))))
    b = by_date(cells, symbol="B")
    assert b[day(2)] == 0.0
    assert b.get(day(3)) is None
    assert b[day(4)] == pytest.approx(round(1 / 23, 6), abs=0)


def test_index_zero_level_drops_date(spark):
    rows = [("A", i, 10 + i) for i in range(4)]
    panel = P.price_panel(stocks_df(spark, rows))
    ret = P.aligned_returns(panel, index_df(spark, {0: 100, 1: 0, 2: 101, 3: 102}))
    assert sorted(r["date"] for r in ret.select("date").distinct().collect()) == [day(1), day(3)]


def test_long_equals_wide_method(spark):
    """Long returns equal the direct wide method (pivot, lag over the date order, dropna)."""
    from pyspark.sql import Window

    from basketlab.plans.catalog import analysis
    from helpers import SF_SMALL

    a = analysis(spark, SF_SMALL)
    panel, idx = a.panel, a.index
    symbols = sorted(r["symbol"] for r in panel.select("symbol").distinct().collect())
    wide = panel.groupBy("date").pivot("symbol", symbols).agg(F.sum("price"))
    wide = wide.join(idx.withColumnRenamed("level", "SP500"), "date")
    w = Window.orderBy("date")
    cols = symbols + ["SP500"]
    exprs = [F.col("date")]
    for c in cols:
        prev = F.lag(F.col(f"`{c}`")).over(w)
        diff = F.col(f"`{c}`") - prev
        exprs.append(F.round(F.try_divide(F.when(diff.isNull(), 0.0).otherwise(diff), prev), 6).alias(c))
    wret = wide.select(exprs).dropna()
    long_from_wide = wret.select(
        "date",
        F.col("SP500").alias("index_ret"),
        F.explode(F.map_from_arrays(F.array([F.lit(s) for s in symbols]), F.array([F.col(f"`{s}`") for s in symbols]))).alias("symbol", "ret"),
    ).select("date", "symbol", "ret", "index_ret")
    ours = sorted(tuple(r) for r in a.returns.collect())
    theirs = sorted(tuple(r) for r in long_from_wide.collect())
    assert len(ours) > 0
    assert ours == theirs


def test_rows_without_symbol_or_date_are_ignored(spark):
    data = [("A", "2024-01-01", 1.0, "x"), ("A", "2024-01-02", 2.0, "y"), (None, "2024-01-02", 5.0, "z"),
            ("A", "bad-date", 7.0, "w")]
    stocks = spark.createDataFrame(data, "symbol string, date string, adjClose double, label string")
    panel = P.price_panel(stocks)
    assert sorted((r["symbol"], r["price"]) for r in panel.collect()) == [("A", 1.0), ("A", 2.0)]
    ret = P.aligned_returns(panel, index_df(spark, {0: 100.0, 1: 101.0}))
    assert [r["ret"] for r in ret.collect()] == [1.0]


def test_repeated_universe_ticker_counts_once(spark):
    rows = [(s, i, 10 + i + k) for k, s in enumerate("AB") for i in range(4)]
    panel = P.price_panel(stocks_df(spark, rows))
    idx = index_df(spark, {i: 100 + i for i in range(4)})
    assert P.aligned_returns(panel, idx, universe=["B", "A", "B"]).count() == 6


def test_dataframe_universe(spark):
    rows = [(s, i, 10 + i + k) for k, s in enumerate("ABC") for i in range(4)]
    panel = P.price_panel(stocks_df(spark, rows))
    idx = index_df(spark, {i: 100 + i for i in range(4)})
    u = spark.createDataFrame([("C", 0), ("A", 1)], "symbol string, upos int")
    assert {r["symbol"] for r in P.aligned_returns(panel, idx, universe=u).collect()} == {"A", "C"}
    missing = spark.createDataFrame([("C", 0), ("ZZZ", 1)], "symbol string, upos int")
    assert P.aligned_returns(panel, idx, universe=missing).count() == 0


def test_non_numeric_index_level_keeps_its_date(spark):
    import datetime as dt

    from basketlab.sources.index import index_series

    rows = [("A", i, 10 + i) for i in range(5)]
    panel = P.price_panel(stocks_df(spark, rows))
    texts = [(day(i).strftime("%m/%d/%Y"), v) for i, v in enumerate(["100", "101", "n/a", "103", "104"])]
    idx = index_series(spark.createDataFrame(texts, "Date string, Close string"))
    got = {r["date"]: r["index_ret"] for r in P.aligned_returns(panel, idx).collect()}
    # day 2: missing level today -> index return 0; day 3: missing yesterday -> date dropped
    assert got == {day(1): round(1 / 100, 6), day(2): 0.0, day(4): round(1 / 103, 6)}
