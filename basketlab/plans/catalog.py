"""Registered queries over the test tables, and their DuckDB oracle SQL.

Every query builds the pipeline inputs from ``lineitem`` and ``part``
(``sources.fixtures``) and runs one stage of :class:`Analysis` over the whole
tables. The oracle SQL recomputes the same stage independently in DuckDB.

Rounding parity: Spark's ``round`` is half-up on the decimal text of a double,
DuckDB's works on the binary value; the oracle therefore rounds through the
text (``_sround``). Statistics use the same exact integer sums on both sides.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.config import TEST_CONFIG, PipelineConfig
from basketlab.operators import panel as P
from basketlab.plans.analysis import Analysis
from basketlab.sources import fixtures as X
from basketlab.sources.prices import flatten_history
from basketlab.session import checkpoint_dir, materialize


# The tickers of the test tables, for the wide views.
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


# Daily prices of the six part types: a long history with few tickers.
DAY = {"symbol": "type", "period": "day"}
DAY_CONFIG = PipelineConfig(corr_lo=-0.03, corr_hi=0.99, min_size=2)


def analysis(
    spark: SparkSession,
    sf_dir: str,
    config: PipelineConfig = TEST_CONFIG,
    optimal: bool = False,
    materialize_stages: bool = True,
    symbol: str = "brand",
    period: str = "quarter",
) -> Analysis:
    """The analysis over inputs derived from the test tables (one scan of ``lineitem``)."""
    sums = X.brand_sums(spark, sf_dir, symbol, period)
    if materialize_stages:
        sums = materialize(sums, "brand_quarters")
    return Analysis(
        stocks=X.stocks_from_sums(sums),
        index_raw=X.index_from_sums(sums),
        companies=X.companies(spark, sf_dir, symbol),
        config=config,
        optimal=optimal,
        materialize_stages=materialize_stages,
    )


def _stage(name: str, optimal: bool = False, **inputs) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(analysis(spark, sf_dir, optimal=optimal, **inputs), name)

    run.__name__ = f"stage_{name}"
    return run


def q_flatten_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_history(X.price_documents(spark, sf_dir)).select("symbol", "date", "adjClose", "label")


def q_price_panel_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pivot_panel(analysis(spark, sf_dir).panel, BRANDS)


def q_returns_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.returns_wide(analysis(spark, sf_dir).returns, BRANDS)


def q_index_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = analysis(spark, sf_dir)
    return P.index_returns(a.index, P.calendar(a.panel, a.index))


def q_dropped_dates(spark: SparkSession, sf_dir: str, period: str = "quarter") -> DataFrame:
    a = analysis(spark, sf_dir, period=period)
    return P.dropped_dates(a.panel, a.index, a.returns)


def q_covariance_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketlab.operators.stats import covariance

    cov = covariance(analysis(spark, sf_dir, period="week").returns)
    return cov.withColumn("cov", F.round("cov", 9))


def q_member_stats_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketlab.operators.stats import member_stats

    return member_stats(analysis(spark, sf_dir, **DAY).returns)


def q_member_stats_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and beta of every ticker on weekly data, where dates drop out and prices are missing."""
    from basketlab.operators.stats import member_stats

    return member_stats(analysis(spark, sf_dir, period="week").returns)


def q_index_series_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly index with bad rows: every fifth level is no number, every seventh date is
    unreadable, every eleventh row lacks a column, every third date comes twice."""
    from basketlab.sources.index import index_series

    raw = X.index_from_sums(X.brand_sums(spark, sf_dir, "brand", "week"))
    k = F.datediff(F.to_date("Date", "MM/dd/yyyy"), F.lit("1990-01-01").cast("date")) / 7
    k = F.floor(k).cast("int")
    rows = raw.select(
        F.when(k % 7 == 0, F.lit("bad")).otherwise(F.col("Date")).alias("Date"),
        F.when(k % 5 == 0, F.concat(F.lit("n/a "), F.col("Close"))).otherwise(F.col("Close")).alias("Close"),
        F.when(k % 11 != 0, F.lit("x")).alias("Note"),
        F.when(k % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("_again"),
    )
    again = rows.select("Date", "Close", "Note", F.explode("_again").alias("_n"))
    level = F.when(F.col("_n") == 1, F.lit("1.5")).otherwise(F.col("Close"))
    return index_series(again.select("Date", level.alias("Close"), "Note"))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/basketlab-{name}-{uuid.uuid4().hex}"


def q_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price documents written as JSON, read back by the document reader, flattened, stored and summed to the panel."""
    from basketlab.sinks.writers import write_table
    from basketlab.sources.prices import read_price_documents, read_stocks

    docs, stocks = _folder(spark, "docs"), _folder(spark, "stocks")
    X.price_documents(spark, sf_dir).write.json(docs)
    write_table(flatten_history(read_price_documents(spark, docs, multi_line=False)), stocks)
    return P.price_panel(read_stocks(spark, stocks))


def q_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One multi-line document per file, beside files that are cut off, empty, or hold an error message or
    a history that is no array; every other ticker's prices are text. Read file by file and summed to the panel."""
    from basketlab.sources.prices import read_price_records

    docs = X.price_documents(spark, sf_dir)
    as_text = F.transform("historical", lambda r: F.struct(r["date"].alias("date"), r["adjClose"].cast("string").alias("adjClose"), r["label"].alias("label")))
    text = lambda history: F.to_json(F.struct("symbol", history.alias("historical")), {"pretty": "true"})
    odd = F.pmod(F.xxhash64("symbol"), F.lit(2)) == 1
    good = F.when(odd, text(as_text)).otherwise(text(F.col("historical")))
    bad = [F.substring(good, 1, 200), F.lit(""), F.lit('{"Error Message": "Limit reached"}'), F.lit('{\n "symbol": "X", "historical": "none"\n}')]
    files = docs.select("symbol", F.posexplode(F.array(good, *bad)).alias("k", "value"))
    folder = _folder(spark, "documents")
    files.select(F.concat_ws("-", "symbol", "k").alias("file"), "value").repartition("file").write.partitionBy("file").text(folder, lineSep="\n")
    return P.price_panel(read_price_records(spark, folder))


def q_catalog_hand_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stocks stored as a catalog table bucketed by ticker, read back by name and summed to the panel."""
    from basketlab.sinks.writers import write_table
    from basketlab.sources.prices import read_stocks

    name = f"basketlab_stocks_{uuid.uuid4().hex}"
    write_table(X.stocks_table(spark, sf_dir), name, bucket_by="symbol", buckets=8, location=_folder(spark, "stocks"))
    return P.price_panel(read_stocks(spark, name))


def q_report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each holding in the report as it is stored."""
    from basketlab.plans.pipeline import in_order
    from basketlab.sinks.writers import read_in_order, write_table

    target = _folder(spark, "holdings")
    write_table(in_order(analysis(spark, sf_dir).holdings), target)
    return read_in_order(spark, target).select("Names", "Portfolios", "Weightage", "position")


def q_published_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch on files: stocks, index and companies written and read, analysed and published; the published detail."""
    from basketlab.plans.pipeline import run_pipeline
    from basketlab.sinks.publish import read_published
    from basketlab.sinks.writers import write_csv, write_table

    stocks, index, companies, root = (_folder(spark, n) for n in ("stocks", "index", "companies", "published"))
    sums = materialize(X.brand_sums(spark, sf_dir), "brand_quarters")
    write_table(X.stocks_from_sums(sums), stocks)
    write_csv(X.index_from_sums(sums), index)
    write_csv(X.companies(spark, sf_dir), companies)
    run_pipeline(spark, stocks, index, companies, TEST_CONFIG, publish_root=root)
    return read_published(spark, root, "PortfoliosDetail")


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index and company files written and read as CSV: the index's series, and the number of companies."""
    from basketlab.sinks.writers import write_csv
    from basketlab.sources.index import index_series, read_companies, read_csv_text

    index, companies = _folder(spark, "index"), _folder(spark, "companies")
    write_csv(X.index_text(spark, sf_dir), index)
    write_csv(X.companies(spark, sf_dir), companies, single_file=True)
    n = read_companies(spark, companies).agg(F.countDistinct("symbol", "company_name").alias("companies"))
    return index_series(read_csv_text(spark, index)).crossJoin(F.broadcast(n))  # one row


def q_table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings stored in name order and read back by path."""
    from basketlab.sinks.writers import write_table
    from basketlab.sources.prices import read_stocks

    target = _folder(spark, "holdings")
    write_table(analysis(spark, sf_dir).holdings.orderBy("Names"), target)
    return read_stocks(spark, target)


def q_snapshot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated archive of the panel: two days, the first written twice; every archived row."""
    from basketlab.sinks.writers import write_snapshot

    target, a = _folder(spark, "snapshot"), analysis(spark, sf_dir)
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        write_snapshot(a.panel, target, day)
    return spark.read.parquet(target).withColumn("run_date", F.col("run_date").cast("string"))


def q_min_variance_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = analysis(spark, sf_dir, optimal=True).optimal_weights
    return w.select("portfolio", "pos", "symbol", F.round("weight_exact", 6).alias("weight_exact"), "weight")


def q_correlation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketlab.operators.stats import correlation_wide

    return correlation_wide(analysis(spark, sf_dir).corr, BRANDS)


def q_basket_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketlab.operators.baskets import basket_arrays

    return basket_arrays(analysis(spark, sf_dir).baskets)


def q_baskets_listed_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets over an ordered ticker list (every brand, brand number descending).

    A listed universe keeps its own order for seeds and members, like the
    original batch's literal ticker list; here the list is a Spark DataFrame.
    """
    brands = X.read_table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol")).distinct()
    listed = brands.select(
        "symbol", (-F.split(F.col("symbol"), "#").getItem(1).cast("int")).alias("upos")
    )
    a = analysis(spark, sf_dir)
    a.universe_df = listed
    return a.baskets


def q_weights_kkt_violations(spark: SparkSession, sf_dir: str, tol: float = 1e-7) -> DataFrame:
    """Validity and optimality of the weights, without forming member pairs.

    With ``p(d) = sum_j w_j r_j(d)`` the basket's return series, the gradient
    ``(S w)_i = cov(r_i, p)`` and ``w'Sw = sum_i w_i (S w)_i``; at the optimum
    the gradient equals ``w'Sw`` on held names and is >= it elsewhere.
    """
    a = analysis(spark, sf_dir, optimal=True)
    w = materialize(a.optimal_weights, "weights")
    return kkt_violations(w, a.returns, a.baskets, tol)


def kkt_violations(weights: DataFrame, returns: DataFrame, baskets: DataFrame, tol: float = 1e-7) -> DataFrame:
    """One row: ``violations`` of the optimality conditions, ``negative`` weights, ``bad_sums``
    (baskets whose weights do not sum to 1), ``bad_rounding`` (rounded weight not the half-even
    of the exact one), ``missing`` and ``extra`` members against ``baskets``, and the counts
    ``n_baskets`` and ``n_members`` of the weights."""
    w = weights.select("portfolio", "symbol", "weight_exact", "weight")
    r = returns.select("date", "symbol", "ret")
    member_rows = w.join(r, "symbol")
    series = member_rows.groupBy("portfolio", "date").agg(F.sum(F.col("weight_exact") * F.col("ret")).alias("p"))
    grad = (
        member_rows.join(series, ["portfolio", "date"])
        .groupBy("portfolio", "symbol")
        .agg(F.covar_samp("ret", "p").alias("g"), F.first("weight_exact").alias("wa"))
    )
    var = grad.groupBy("portfolio").agg(F.sum(F.col("g") * F.col("wa")).alias("v"))
    j = grad.join(var, "portfolio")
    rel = (F.col("g") - F.col("v")) / F.greatest(F.abs(F.col("v")), F.lit(1e-300))
    bad = F.when(F.abs("wa") > 1e-12, F.abs(rel) > tol).otherwise(rel < -tol)
    count = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0)).cast("bigint")
    optimal = j.agg(count(bad).alias("violations"))
    rounded = F.bround("weight_exact", 2).cast("float")
    signs = w.agg(
        count(F.col("weight_exact") < 0).alias("negative"),
        count(~rounded.eqNullSafe(F.col("weight"))).alias("bad_rounding"),
        F.countDistinct("portfolio").cast("bigint").alias("n_baskets"),
        F.count("*").alias("n_members"),
    )
    sums = w.groupBy("portfolio").agg(F.sum("weight_exact").alias("t")).agg(count(F.abs(F.col("t") - 1) > 1e-9).alias("bad_sums"))
    both = baskets.select("portfolio", "symbol", F.lit(1).alias("b")).join(w.select("portfolio", "symbol", F.lit(1).alias("w")), ["portfolio", "symbol"], "full")
    members = both.agg(count(F.col("w").isNull()).alias("missing"), count(F.col("b").isNull()).alias("extra"))
    out = optimal
    for one_row in (signs, sums, members):
        out = out.crossJoin(F.broadcast(one_row))  # each side is a single row
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flatten_history": q_flatten_history,
    "price_panel": _stage("panel"),
    "price_panel_wide": q_price_panel_wide,
    "index_series": _stage("index"),
    "aligned_returns": _stage("returns"),
    "aligned_returns_wide": q_returns_wide,
    "index_returns": q_index_returns,
    "dropped_dates": q_dropped_dates,
    "correlation_matrix": _stage("corr"),
    "correlation_matrix_wide": q_correlation_wide,
    "correlated_peers": _stage("peers"),
    "baskets": _stage("baskets"),
    "baskets_listed_universe": q_baskets_listed_universe,
    "basket_members": q_basket_members,
    "basket_universe": _stage("members"),
    "mean_returns": _stage("means"),
    "covariance": _stage("cov"),
    "betas": _stage("betas"),
    "latest_close": _stage("latest"),
    "equal_weights": _stage("equal_weights"),
    "equal_weight_risk": _stage("risk"),
    "equal_weight_return": _stage("expected_return"),
    "equal_weight_summary": _stage("summary"),
    "equal_weight_holdings": _stage("holdings"),
    "equal_weight_detail": _stage("detail"),
    "min_variance_weights": q_min_variance_weights,
    "weights_kkt_violations": q_weights_kkt_violations,
    "optimal_risk": _stage("risk", optimal=True),
    "optimal_summary": _stage("summary", optimal=True),
    "optimal_holdings": _stage("holdings", optimal=True),
    "optimal_detail": _stage("detail", optimal=True),
    "correlated_peers_default": _stage("peers", config=PipelineConfig()),
    "aligned_returns_week": _stage("returns", period="week"),
    "dropped_dates_week": lambda spark, sf_dir: q_dropped_dates(spark, sf_dir, "week"),
    "correlation_matrix_week": _stage("corr", period="week"),
    "member_stats_week": q_member_stats_week,
    "covariance_week": q_covariance_week,
    "basket_covariance": _stage("basket_cov"),
    "correlation_matrix_day": _stage("corr", **DAY),
    "baskets_day": _stage("baskets", config=DAY_CONFIG, **DAY),
    "member_stats_day": q_member_stats_day,
    "optimal_summary_day": _stage("summary", optimal=True, config=DAY_CONFIG, **DAY),
    "index_series_dirty": q_index_series_dirty,
    "json_round_trip": q_json_round_trip,
    "csv_round_trip": q_csv_round_trip,
    "table_round_trip": q_table_round_trip,
    "snapshot_round_trip": q_snapshot_round_trip,
    "json_documents": q_json_documents,
    "catalog_hand_over": q_catalog_hand_over,
    "report_order": q_report_order,
    "published_detail": q_published_detail,
}


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------


def _sround(x: str, d: int) -> str:
    """Spark ``round(double, d)``: half-up on the shortest decimal text of the value."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,24)), {d}) AS DOUBLE)"


def _fround(x: str, d: int) -> str:
    """Spark ``round(float, d)`` (computed on the float's double value), as FLOAT."""
    return f"CAST({_sround(f'CAST(CAST(({x}) AS FLOAT) AS DOUBLE)', d)} AS FLOAT)"


def _half_up_div(num: str, den: str) -> str:
    return (
        f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(sign({num}) * sign({den}) * "
        f"((2 * abs({num}) + abs({den})) // (2 * abs({den}))) AS BIGINT) END"
    )


def _ret(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} = 0 THEN NULL ELSE coalesce({cur} - {prev}, 0.0::DOUBLE) / {prev} END"


def _base_ctes(cfg: PipelineConfig = TEST_CONFIG, period: str = "quarter", ticker: str = "p_brand", plain: bool = False) -> dict[str, str]:
    """``plain``: correlation, covariance, mean and slope by DuckDB's own aggregates instead of exact sums."""
    rd = cfg.return_decimals
    ru = f"{10.0 ** rd!r}::DOUBLE"
    lo, hi = cfg.corr_lo, cfg.corr_hi
    c: dict[str, str] = {}
    c["trades"] = f"""
      SELECT CAST(date_trunc('{period}', l_shipdate) AS DATE) AS date, {ticker} AS symbol,
             CAST(round(l_extendedprice * 100.0::DOUBLE) AS BIGINT) AS e_cents,
             CAST(round(l_quantity * 100.0::DOUBLE) AS BIGINT) AS q_cents
      FROM lineitem JOIN part ON l_partkey = p_partkey"""
    vwap = (
        "CASE WHEN sum(q_cents) = 0 THEN NULL ELSE (CAST(sum(e_cents) AS DOUBLE) / 100.0::DOUBLE) "
        "/ (CAST(sum(q_cents) AS DOUBLE) / 100.0::DOUBLE) END"
    )
    c["panel"] = f"SELECT date, symbol, {vwap} AS price FROM trades GROUP BY date, symbol"
    c["idx"] = f"SELECT date, {vwap} AS level FROM trades GROUP BY date"
    c["cal"] = """
      SELECT date, lead(date) OVER (ORDER BY date) AS next_date
      FROM (SELECT DISTINCT date FROM panel) p JOIN (SELECT DISTINCT date FROM idx) i USING (date)"""
    c["cells"] = f"""
      SELECT c.next_date AS date, p.symbol, {_sround(_ret('q.price', 'p.price'), rd)} AS ret
      FROM panel p JOIN cal c ON p.date = c.date AND c.next_date IS NOT NULL
      LEFT JOIN panel q ON q.date = c.next_date AND q.symbol = p.symbol"""
    c["good"] = """
      SELECT date FROM cells GROUP BY date
      HAVING count(ret) = (SELECT count(DISTINCT symbol) FROM panel)"""
    c["iret"] = f"""
      SELECT c.next_date AS date, {_sround(_ret('j.level', 'i.level'), rd)} AS index_ret
      FROM idx i JOIN cal c ON i.date = c.date AND c.next_date IS NOT NULL
      JOIN idx j ON j.date = c.next_date"""
    c["returns"] = """
      SELECT c.date, c.symbol, c.ret, r.index_ret
      FROM cells c JOIN good g ON g.date = c.date JOIN iret r ON r.date = c.date
      WHERE r.index_ret IS NOT NULL"""
    c["ru"] = f"SELECT date, symbol, CAST(round(ret * {ru}) AS BIGINT) AS x, CAST(round(index_ret * {ru}) AS BIGINT) AS ix FROM returns"
    c["pm"] = """
      SELECT symbol_a, symbol_b, n,
             n * sab - sa * sb AS cov_num, n * saa - sa * sa AS var_a, n * sbb - sb * sb AS var_b
      FROM (SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, count(*) AS n,
                   CAST(sum(a.x) AS HUGEINT) AS sa, CAST(sum(b.x) AS HUGEINT) AS sb,
                   sum(CAST(a.x AS HUGEINT) * a.x) AS saa, sum(CAST(b.x AS HUGEINT) * b.x) AS sbb,
                   sum(CAST(a.x AS HUGEINT) * b.x) AS sab
            FROM ru a JOIN ru b ON a.date = b.date AND a.symbol <= b.symbol
            GROUP BY a.symbol, b.symbol)"""
    den = "sqrt(CAST(var_a AS DOUBLE) * CAST(var_b AS DOUBLE))"
    c["corr_half"] = f"""
      SELECT symbol_a, symbol_b,
             {_sround(f"CASE WHEN {den} > 0 THEN CAST(cov_num AS DOUBLE) / {den} END", cfg.corr_decimals)} AS corr
      FROM pm"""
    pairs = "FROM returns a JOIN returns b ON a.date = b.date AND a.symbol <= b.symbol GROUP BY a.symbol, b.symbol"
    if plain:
        c["corr_half"] = f"SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, {_sround("nullif(corr(a.ret, b.ret), 'nan'::DOUBLE)", cfg.corr_decimals)} AS corr {pairs}"
    c["corr"] = """
      SELECT symbol_a, symbol_b, corr FROM corr_half
      UNION ALL SELECT symbol_b AS symbol_a, symbol_a AS symbol_b, corr FROM corr_half WHERE symbol_a <> symbol_b"""
    c["peers"] = f"""
      SELECT symbol_b AS seed, symbol_a AS symbol, corr FROM corr
      WHERE corr BETWEEN {lo!r}::DOUBLE AND {hi!r}::DOUBLE"""
    c["seeds"] = f"""
      SELECT u.symbol AS seed, coalesce(k.n_peers, 0) + 1 AS n
      FROM (SELECT DISTINCT symbol FROM panel) u
      LEFT JOIN (SELECT seed, count(*) AS n_peers FROM peers GROUP BY seed) k ON k.seed = u.symbol
      WHERE coalesce(k.n_peers, 0) + 1 BETWEEN {cfg.min_size} AND {cfg.max_size}"""
    c["named"] = """
      SELECT seed, n, 'Portfolio' || CAST(row_number() OVER (ORDER BY seed) AS VARCHAR) AS portfolio FROM seeds"""
    c["baskets"] = """
      SELECT nm.portfolio, CAST(row_number() OVER (PARTITION BY nm.portfolio ORDER BY p.symbol) - 1 AS INTEGER) AS pos,
             p.symbol
      FROM peers p JOIN named nm ON nm.seed = p.seed
      UNION ALL SELECT portfolio, CAST(n - 1 AS INTEGER) AS pos, seed AS symbol FROM named"""
    c["members"] = "SELECT DISTINCT symbol FROM baskets"
    c["pm_members"] = """
      SELECT * FROM pm WHERE symbol_a IN (SELECT symbol FROM members) AND symbol_b IN (SELECT symbol FROM members)"""
    md = cfg.mean_decimals
    c["means_all"] = f"""
      SELECT symbol, CAST({_half_up_div('sx', 'n')} AS DOUBLE) / {10.0 ** md!r}::DOUBLE AS mean
      FROM (SELECT symbol, sum(CAST(x AS HUGEINT)) AS sx, CAST(count(x) AS HUGEINT) AS n FROM ru GROUP BY symbol)"""
    if plain:
        c["means_all"] = f"SELECT symbol, {_sround('avg(ret)', md)} AS mean FROM returns GROUP BY symbol"
    c["means"] = "SELECT * FROM means_all WHERE symbol IN (SELECT symbol FROM members)"
    cov_scale = f"{10.0 ** (2 * rd)!r}::DOUBLE"
    c["cov_half"] = f"""
      SELECT symbol_a, symbol_b,
             CASE WHEN n > 1 THEN CAST(cov_num AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE) / {cov_scale} END AS cov
      FROM pm_members"""
    if plain:
        c["cov_half"] = f"SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, {_sround("nullif(covar_samp(a.ret, b.ret), 'nan'::DOUBLE)", 9)} AS cov {pairs}"
    c["cov"] = """
      SELECT symbol_a, symbol_b, cov FROM cov_half
      UNION ALL SELECT symbol_b AS symbol_a, symbol_a AS symbol_b, cov FROM cov_half WHERE symbol_a <> symbol_b"""
    bd = cfg.beta_decimals
    c["betas_all"] = f"""
      SELECT symbol,
             coalesce(CAST({_half_up_div(f'cov_num * {10 ** bd}', 'var_x')} AS DOUBLE) / {10.0 ** bd!r}::DOUBLE, 0.0::DOUBLE) AS beta
      FROM (SELECT symbol, n * sxy - sx * sy AS cov_num, n * sxx - sx * sx AS var_x
            FROM (SELECT symbol, CAST(count(*) AS HUGEINT) AS n, CAST(sum(ix) AS HUGEINT) AS sx,
                         CAST(sum(x) AS HUGEINT) AS sy, sum(CAST(ix AS HUGEINT) * ix) AS sxx,
                         sum(CAST(ix AS HUGEINT) * x) AS sxy
                  FROM ru GROUP BY symbol))"""
    if plain:
        c["betas_all"] = f"SELECT symbol, {_sround("coalesce(nullif(regr_slope(ret, index_ret), 'nan'::DOUBLE), 0.0)", bd)} AS beta FROM returns GROUP BY symbol"
    c["betas"] = "SELECT * FROM betas_all WHERE symbol IN (SELECT symbol FROM members)"
    c["latest"] = """
      SELECT symbol, date, price FROM panel
      WHERE date = (SELECT max(date) FROM panel) AND symbol IN (SELECT symbol FROM members)"""
    wd = cfg.weight_decimals
    c["eqw"] = f"""
      SELECT portfolio, pos, symbol, 1.0::DOUBLE / n AS weight_exact,
             CAST(round_even(1.0::DOUBLE / n, {wd}) AS FLOAT) AS weight
      FROM (SELECT portfolio, pos, symbol, count(*) OVER (PARTITION BY portfolio) AS n FROM baskets)"""
    # minimum-variance weights: every support of a basket by sweeping its covariance matrix,
    # bordered by ones; of the feasible supports that with the largest sum has the least variance
    c["size"] = "SELECT portfolio, CAST(max(pos) + 1 AS INTEGER) AS n FROM baskets GROUP BY portfolio"
    c["cells_cov"] = """
      SELECT s.portfolio, s.n, i.i, j.i AS j,
             CASE WHEN i.i = s.n AND j.i = s.n THEN 0.0::DOUBLE WHEN i.i = s.n OR j.i = s.n THEN 1.0::DOUBLE ELSE v.cov * 1e4 END AS v
      FROM size s JOIN (SELECT unnest(range(0, 11)) AS i) i ON i.i <= s.n JOIN (SELECT unnest(range(0, 11)) AS i) j ON j.i <= s.n
      LEFT JOIN baskets a ON a.portfolio = s.portfolio AND a.pos = i.i LEFT JOIN baskets b ON b.portfolio = s.portfolio AND b.pos = j.i
      LEFT JOIN cov v ON v.symbol_a = a.symbol AND v.symbol_b = b.symbol"""
    c["start"] = "SELECT portfolio, n, list(v ORDER BY i, j) AS m FROM cells_cov GROUP BY portfolio, n"
    at = "m[(p // (n + 1)) * (n + 1) + k + 1]"  # column k of the row of p
    row = "m[k * (n + 1) + p % (n + 1) + 1]"  # row k, column of p
    d = "m[k * (n + 1) + k + 1]"
    swept = f"""list_transform(range(0, (n + 1) * (n + 1)), lambda p:
               CASE WHEN p // (n + 1) = k AND p % (n + 1) = k THEN 1.0 / {d} WHEN p // (n + 1) = k THEN m[p + 1] / {d}
                    WHEN p % (n + 1) = k THEN -m[p + 1] / {d} ELSE m[p + 1] - {at} * {row} / {d} END)"""
    c["sweep"] = f"""
      SELECT portfolio, n, 0 AS k, []::INTEGER[] AS held, m FROM start
      UNION ALL SELECT portfolio, n, k + 1, CASE WHEN t.hold THEN list_append(held, k) ELSE held END, CASE WHEN t.hold THEN {swept} ELSE m END
      FROM sweep, (VALUES (true), (false)) t(hold) WHERE k < n"""
    c["supports"] = """
      SELECT portfolio, n, held, list_transform(held, lambda h: m[h * (n + 1) + n + 1]) AS x FROM sweep WHERE k = n AND len(held) > 0"""
    c["best"] = """
      SELECT portfolio, n, held, x FROM supports WHERE list_min(x) >= 0
      QUALIFY row_number() OVER (PARTITION BY portfolio ORDER BY list_sum(x) DESC) = 1"""
    c["optw"] = f"""
      SELECT b.portfolio, b.pos, b.symbol, w AS weight_exact, CAST(round_even(w, {wd}) AS FLOAT) AS weight
      FROM (SELECT b.*, coalesce(z.x[list_position(z.held, b.pos)], 0.0) / list_sum(z.x) AS w
            FROM baskets b JOIN best z ON z.portfolio = b.portfolio) b"""
    c["companies"] = f"SELECT DISTINCT {ticker} AS symbol, 'Company ' || {ticker} AS company_name FROM part"
    for prefix, weights in (("", "eqw"), ("o_", "optw")):
        c |= _report_ctes(prefix, weights, cfg)
    return c


def _report_ctes(prefix: str, weights: str, cfg: PipelineConfig) -> dict[str, str]:
    """Risk, return, summary, holdings and detail for one table of weights."""
    c: dict[str, str] = {}
    rd, wd, md = cfg.return_decimals, cfg.weight_decimals, cfg.mean_decimals
    wu = f"CAST(round(w.weight * {10.0 ** wd!r}::DOUBLE) AS BIGINT)"
    c[f"{prefix}risk"] = f"""
      SELECT portfolio,
             CASE WHEN n > 1 THEN sqrt(CAST(n * svv - sv * sv AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE))
                  / {10.0 ** (wd + rd)!r}::DOUBLE * sqrt({float(cfg.periods_per_year)!r}::DOUBLE) END AS risk
      FROM (SELECT portfolio, CAST(count(*) AS HUGEINT) AS n, sum(v) AS sv, sum(v * v) AS svv
            FROM (SELECT w.portfolio, r.date, sum(CAST({wu} AS HUGEINT) * r.x) AS v
                  FROM {weights} w JOIN ru r ON r.symbol = w.symbol GROUP BY w.portfolio, r.date)
            GROUP BY portfolio)"""
    mu = f"CAST(round(m.mean * {10.0 ** md!r}::DOUBLE) AS BIGINT)"
    tr = (
        f"CAST(sum(CAST({wu} AS HUGEINT) * {mu}) * {cfg.periods_per_year} AS DOUBLE)"
        f" / {10.0 ** (wd + md)!r}::DOUBLE"
    )
    c[f"{prefix}ret_port"] = f"""
      SELECT w.portfolio, {_fround(tr, cfg.report_decimals)} AS total_return
      FROM {weights} w LEFT JOIN means m ON m.symbol = w.symbol GROUP BY w.portfolio"""
    amt = "sum(CAST(w.weight * CAST(l.price AS FLOAT) AS DOUBLE))"
    pb = "sum(CAST(w.weight * CAST(b.beta AS FLOAT) AS DOUBLE))"
    c[f"{prefix}summary"] = f"""
      SELECT w.portfolio AS "Names",
             list(w.symbol ORDER BY w.pos) AS "Portfolios",
             list(w.weight ORDER BY w.pos) AS "Weightage",
             {_fround(tr, cfg.report_decimals)} AS "TotalReturns",
             CASE WHEN count(l.price) = count(*) THEN {_sround(amt, cfg.report_decimals)} END AS "InvestmentAmount",
             CASE WHEN count(b.beta) = count(*) AND {_sround(pb, cfg.report_decimals)} > {cfg.high_beta_threshold!r}::DOUBLE
                  THEN 'High' ELSE 'Low' END AS "Volatility"
      FROM {weights} w LEFT JOIN means m ON m.symbol = w.symbol
      LEFT JOIN latest l ON l.symbol = w.symbol LEFT JOIN betas b ON b.symbol = w.symbol
      GROUP BY w.portfolio"""
    c[f"{prefix}holdings"] = f"""
      SELECT s."Names", w.symbol AS "Portfolios", w.weight AS "Weightage", s."TotalReturns",
             s."InvestmentAmount", s."Volatility", c.company_name
      FROM {prefix}summary s JOIN {weights} w ON w.portfolio = s."Names" JOIN companies c ON c.symbol = w.symbol
      WHERE w.weight <> 0"""
    c[f"{prefix}detail"] = f"""
      SELECT h.*, p.symbol, p.date, p.price AS "adjClose"
      FROM {prefix}holdings h JOIN panel p ON p.symbol = h."Portfolios\""""
    return c


def _reached(final: str, ctes: dict[str, str]) -> dict[str, str]:
    """The common table expressions that a statement needs, in order."""
    need, todo = set(), [final]
    while todo:
        text = todo.pop()
        for k, v in ctes.items():
            if k not in need and re.search(rf"\b(FROM|JOIN)\s+{k}\b", text, re.I):
                need.add(k)
                todo.append(v)
    return {k: v for k, v in ctes.items() if k in need}


def _conditional(value: str, key: str, agg: str = "sum") -> str:
    return ", ".join(f"{agg}({value}) FILTER (WHERE {key} = '{b}') AS \"{b}\"" for b in BRANDS)


def _with(final: str, cfg: PipelineConfig = TEST_CONFIG, *inputs) -> str:
    ctes = _reached(final, _base_ctes(cfg, *inputs))
    body = ",\n".join(f"{k} AS ({v}\n)" for k, v in ctes.items())
    return f"WITH RECURSIVE {body}\n{final}"


ORACLE_FINALS: dict[str, str] = {
    "flatten_history": """SELECT symbol, strftime(date, '%Y-%m-%d') AS date, price AS "adjClose",
       symbol || ' ' || strftime(date, '%Y-%m-%d') AS label FROM panel""",
    "price_panel": "SELECT date, symbol, price FROM panel",
    "price_panel_wide": f"SELECT date, {_conditional('price', 'symbol')} FROM panel GROUP BY date",
    "index_series": "SELECT date, level FROM idx",
    "aligned_returns": "SELECT date, symbol, ret, index_ret FROM returns",
    "aligned_returns_wide": f"SELECT date, {_conditional('ret', 'symbol')}, max(index_ret) AS \"SP500\" FROM returns GROUP BY date",
    "index_returns": "SELECT date, index_ret FROM iret",
    "dropped_dates": "SELECT date FROM cal WHERE date NOT IN (SELECT date FROM returns)",
    "correlation_matrix": "SELECT symbol_a, symbol_b, corr FROM corr",
    "correlation_matrix_wide": f"SELECT symbol_a AS \"stockName\", {_conditional('corr', 'symbol_b', 'max')} FROM corr GROUP BY symbol_a",
    "correlated_peers": "SELECT seed, symbol, corr FROM peers",
    "baskets": "SELECT portfolio, pos, symbol FROM baskets",
    "baskets_listed_universe": """SELECT nm.portfolio,
             CAST(row_number() OVER (PARTITION BY nm.portfolio ORDER BY CAST(split_part(p.symbol, '#', 2) AS INTEGER) DESC) - 1 AS INTEGER) AS pos,
             p.symbol
       FROM peers p JOIN (SELECT seed, n, 'Portfolio' || CAST(row_number() OVER (ORDER BY CAST(split_part(seed, '#', 2) AS INTEGER) DESC) AS VARCHAR) AS portfolio
                          FROM seeds) nm ON nm.seed = p.seed
       UNION ALL
       SELECT 'Portfolio' || CAST(row_number() OVER (ORDER BY CAST(split_part(seed, '#', 2) AS INTEGER) DESC) AS VARCHAR) AS portfolio,
              CAST(n - 1 AS INTEGER) AS pos, seed AS symbol FROM seeds""",
    "basket_members": "SELECT portfolio, list(symbol ORDER BY pos) AS members FROM baskets GROUP BY portfolio",
    "basket_universe": "SELECT symbol FROM members",
    "mean_returns": "SELECT symbol, mean FROM means",
    "covariance": "SELECT symbol_a, symbol_b, cov FROM cov",
    "basket_covariance": """SELECT symbol_a, symbol_b, cov FROM cov_half
       WHERE EXISTS (FROM baskets a JOIN baskets b ON a.portfolio = b.portfolio WHERE a.symbol = symbol_a AND b.symbol = symbol_b)""",
    "betas": "SELECT symbol, beta FROM betas",
    "latest_close": "SELECT symbol, date, price FROM latest",
    "equal_weights": "SELECT portfolio, pos, symbol, weight_exact, weight FROM eqw",
    "equal_weight_risk": "SELECT portfolio, risk FROM risk",
    "equal_weight_return": "SELECT portfolio, total_return FROM ret_port",
    "equal_weight_summary": "SELECT * FROM summary",
    "equal_weight_holdings": "SELECT * FROM holdings",
    "equal_weight_detail": "SELECT * FROM detail",
    "min_variance_weights": f"SELECT portfolio, pos, symbol, {_sround('weight_exact', 6)} AS weight_exact, weight FROM optw",
    "weights_kkt_violations": """SELECT 0::BIGINT AS violations, 0::BIGINT AS negative, 0::BIGINT AS bad_sums, 0::BIGINT AS bad_rounding,
       0::BIGINT AS missing, 0::BIGINT AS extra, count(DISTINCT portfolio) AS n_baskets, count(*) AS n_members FROM baskets""",
    "optimal_risk": "SELECT portfolio, risk FROM o_risk",
    "optimal_summary": "SELECT * FROM o_summary",
    "optimal_holdings": "SELECT * FROM o_holdings",
    "optimal_detail": "SELECT * FROM o_detail",
    "json_round_trip": "SELECT date, symbol, price FROM panel",
    "csv_round_trip": "SELECT date, level, (SELECT count(*) FROM companies) AS companies FROM idx",
    "table_round_trip": "SELECT * FROM holdings",
    "snapshot_round_trip": """SELECT panel.date, symbol, price, d.run_date
       FROM panel, (SELECT unnest(['2024-01-01', '2024-01-02']) AS run_date) d""",
    "json_documents": "SELECT date, symbol, price FROM panel",
    "catalog_hand_over": "SELECT date, symbol, price FROM panel",
    "report_order": """SELECT "Names", "Portfolios", "Weightage", row_number() OVER (ORDER BY "Names", "Portfolios") AS position FROM holdings""",
    "published_detail": "SELECT * FROM o_detail",
}

#: The same stages on weekly data: dates that drop out, missing prices, zero returns.
WEEK_FINALS: dict[str, str] = {
    "aligned_returns_week": "SELECT date, symbol, ret, index_ret FROM returns",
    "dropped_dates_week": "SELECT date FROM cal WHERE date NOT IN (SELECT date FROM returns)",
    "correlation_matrix_week": "SELECT symbol_a, symbol_b, corr FROM corr",
    "member_stats_week": "SELECT symbol, mean, beta FROM means_all JOIN betas_all USING (symbol)",
    "index_series_dirty": """SELECT date, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 5 = 0 THEN 1.5 ELSE greatest(level, 1.5) END WHEN k % 5 = 0 THEN NULL ELSE level END AS level
       FROM (SELECT date, level, CAST(floor(date_diff('day', DATE '1990-01-01', date) / 7) AS INTEGER) AS k FROM idx) WHERE k % 7 <> 0 AND k % 11 <> 0""",
}


#: By DuckDB's own statistics functions: weekly data, and daily data with over a thousand dates.
PLAIN_WEEK_FINALS = {"covariance_week": "SELECT symbol_a, symbol_b, cov FROM cov"}
PLAIN_DAY_FINALS = {
    "correlation_matrix_day": "SELECT symbol_a, symbol_b, corr FROM corr",
    "baskets_day": "SELECT portfolio, pos, symbol FROM baskets",
    "member_stats_day": "SELECT symbol, mean, beta FROM means_all JOIN betas_all USING (symbol)",
}
DAY_FINALS = {"optimal_summary_day": "SELECT * FROM o_summary"}


def oracle_sql(cfg: PipelineConfig = TEST_CONFIG) -> dict[str, str]:
    found = {k: _with(v, cfg) for k, v in ORACLE_FINALS.items()}
    found |= {k: _with(v, cfg, "week") for k, v in WEEK_FINALS.items()}
    found |= {k: _with(v, cfg, "week", "p_brand", True) for k, v in PLAIN_WEEK_FINALS.items()}
    found |= {k: _with(v, DAY_CONFIG, "day", "p_type", True) for k, v in PLAIN_DAY_FINALS.items()}
    found |= {k: _with(v, DAY_CONFIG, "day", "p_type") for k, v in DAY_FINALS.items()}
    return found | {"correlated_peers_default": _with(ORACLE_FINALS["correlated_peers"], PipelineConfig())}
