"""Correlation, covariance, mean returns and betas.

Statistics are computed from exact integer sums of the rounded returns
(``functions.numeric``): the same answer for any partitioning or task order,
and no ANSI division error for a constant series (its correlation is null,
its covariance 0.0, a constant index gives beta 0.0).

The complete-case rule gives every ticker the same dates, so counts, sums and
sums of squares belong to tickers (one ``groupBy(symbol)``); only the sum of
products belongs to a pair. That one is a Gram product by blocks: tickers hash
into blocks and dates fall into ranges of fixed length, each (block, block,
range) is one group of bounded size, and the partial sums add up in Spark.
Values are split into sign and limbs of 20 bits, whose products stay exact in
BLAS for every 64-bit value, and a group's sum leaves it as two 64-bit words.
Sums are exact up to 38 digits for any number of days; beyond that they are an
error, never a wrong or null value.

Peers and basket covariances need few of the pairs. There a group holds whole
histories of two blocks (fewer tickers the longer the history): peers drop
pairs by Cauchy-Schwarz bounds date range by date range, covariances take only
the pairs that share a basket.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.functions.shipping import ship_by_value

from basketlab.functions.numeric import div_half_up, exact, scaled, units


def _units_frame(returns: DataFrame, decimals: int, symbols: DataFrame | None) -> DataFrame:
    r = returns.select("date", "symbol", units("ret", decimals).alias("x"))
    if symbols is not None:
        r = r.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    return r


LIMB = 20  # bits of a limb: 4 products of 40 bits over 2**10 days stay below 2**53
LIMBS = 4
DAY_SPAN = 1024  # calendar days of one group, and days whose products are added in floating point
BLOCK_TICKERS = 512  # most tickers of a block, on average
BLOCK_CELLS = 1 << 20  # most (day, ticker) cells of a block that holds whole histories, on average
WORD = 60  # bits of the low word of a sum: sum = hi * 2**60 + lo
SLACK = 1e-9  # bound on rounding errors of a correlation in floating point
PAIR_SUMS_SCHEMA = "symbol_a string, symbol_b string, hi bigint, lo bigint"


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x = sum(limb_k * 2**(20 k))``, every limb with the sign of ``x``. Limbs that are 0 throughout are None.

    Sign and magnitude, so sums over values of both signs stay as small as the values are.
    """
    size, sign = np.abs(x).view(np.uint64), np.sign(x).astype(np.float64)
    parts = [(size >> np.uint64(LIMB * k)) & np.uint64((1 << LIMB) - 1) for k in range(LIMBS)]
    return [sign * v.astype(np.float64) if v.any() else None for v in parts]


def _two_words(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sum_k sums[k] * 2**(20 k)`` as ``hi * 2**60 + lo`` with ``0 <= lo < 2**60``."""
    mask, carry, lo = (1 << LIMB) - 1, np.zeros_like(sums[0]), np.zeros_like(sums[0])
    for k in range(WORD // LIMB):
        t = sums[k] + carry
        lo |= (t & mask) << (LIMB * k)
        carry = t >> LIMB
    high = [sums[3] + carry, *sums[4:]]
    if np.abs(sum(v * 2.0 ** (LIMB * k) for k, v in enumerate(high))).max(initial=0.0) >= 2.0**62:
        raise OverflowError("a sum of products passes 122 bits")
    return sum(v << (LIMB * k) for k, v in enumerate(high)), lo


def _block_pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """``sum(x_a * x_b)`` in two words for the symbol pairs of one (block, block, date range) group.

    One input row per ticker: its block and its series as ``days``/``xs`` arrays.
    """
    lo, hi = int(pdf["blk_lo"].iloc[0]), int(pdf["blk_hi"].iloc[0])
    syms = pdf["symbol"].to_numpy(dtype=object)
    first = min(int(d[0]) for d in pdf["days"])
    x = np.zeros((max(int(d[-1]) for d in pdf["days"]) - first + 1, len(syms)), dtype=np.int64)
    for j, (d, v) in enumerate(zip(pdf["days"], pdf["xs"])):
        x[np.asarray(d, dtype=np.int64) - first, j] = np.asarray(v, dtype=np.int64)
    blk_of = pdf["blk"].to_numpy(dtype=np.int64)
    ia, ib = np.flatnonzero(blk_of == lo), np.flatnonzero(blk_of == hi)
    la, lb = _limbs(x[:, ia]), _limbs(x[:, ib])
    sums = np.zeros((2 * LIMBS - 1, len(ia), len(ib)), dtype=np.int64)
    for i, a in enumerate(la):
        for j, b in enumerate(lb):
            if a is not None and b is not None:
                sums[i + j] += np.rint(a.T @ b).astype(np.int64)
    ga, gb = (g.ravel() for g in np.meshgrid(np.arange(len(ia)), np.arange(len(ib)), indexing="ij"))
    a_name, b_name = syms[ia][ga], syms[ib][gb]
    keep = a_name <= b_name if lo == hi else np.ones(len(ga), dtype=bool)
    return _pair_rows(a_name[keep], b_name[keep], sums[:, ga[keep], gb[keep]])


def _pair_rows(a: np.ndarray, b: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
    swap = a > b
    hi, lo = _two_words(sums)
    return pd.DataFrame({"symbol_a": np.where(swap, b, a), "symbol_b": np.where(swap, a, b), "hi": hi, "lo": lo})


def _histories(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, block of each, days x names) of a group that holds whole histories, one row per ticker and date range."""
    names, at, col = np.unique(pdf["symbol"].to_numpy(dtype=object), return_index=True, return_inverse=True)
    days = [np.asarray(d, dtype=np.int64) for d in pdf["days"]]
    every = np.unique(np.concatenate(days))
    if (np.bincount(col, weights=[len(d) for d in days], minlength=len(names)) != len(every)).any():
        raise ValueError("returns are not complete-case")
    x = np.zeros((len(every), len(names)), dtype=np.int64)
    for j, d, v in zip(col, days, pdf["xs"]):
        x[np.searchsorted(every, d), j] = np.asarray(v, dtype=np.int64)
    return names, pdf["blk"].to_numpy(dtype=np.int64)[at], x


def _exact_rows(names: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Exact sums of products of the pairs ``(a, b)`` of columns only."""
    sums = np.zeros((2 * LIMBS - 1, len(a)), dtype=np.int64)
    step = max(1, BLOCK_CELLS // DAY_SPAN)  # pairs at once
    for d in range(0, len(x) if len(a) else 0, DAY_SPAN):
        limbs = _limbs(x[d : d + DAY_SPAN])
        for p in range(0, len(a), step):
            pa, pb = a[p : p + step], b[p : p + step]
            for i, u in enumerate(limbs):
                for j, v in enumerate(limbs):
                    if u is not None and v is not None:
                        sums[i + j, p : p + step] += np.rint(np.einsum("dp,dp->p", u[:, pa], v[:, pb])).astype(np.int64)
    return _pair_rows(names[a], names[b], sums)


def _pairs_in_range(pdf: pd.DataFrame, low: float, high: float) -> pd.DataFrame:
    """Exact sums for those pairs of a (block, block) group whose correlation can lie in ``[low, high]``.

    Series are standardised to mean 0 and length 1, so a correlation is a dot
    product, taken date range by date range. By Cauchy-Schwarz the ranges still
    to come change it by at most the product of the two lengths that are left;
    a pair that cannot reach the interval any more is dropped, and the group
    ends when none is left. A constant series has no correlation.
    """
    names, blk_of, x = _histories(pdf)
    lo, hi = int(pdf["blk_lo"].iloc[0]), int(pdf["blk_hi"].iloc[0])
    ia, ib = np.flatnonzero(blk_of == lo), np.flatnonzero(blk_of == hi)
    z = (x - x[:1]).astype(np.float64)
    z -= z.mean(axis=0)
    length = np.sqrt((z * z).sum(axis=0))
    varies = (x != x[:1]).any(axis=0)
    z /= np.where(varies, length, 1.0)
    live = varies[ia][:, None] & varies[ib][None, :]
    if lo == hi:
        live &= np.arange(len(ia))[:, None] <= np.arange(len(ib))[None, :]
    dot, left = np.zeros(live.shape), np.ones(len(names))
    for d in range(0, len(z), DAY_SPAN // 8):
        if not live.any():
            break
        part = z[d : d + DAY_SPAN // 8]
        dot += part[:, ia].T @ part[:, ib]
        left = np.maximum(left - (part * part).sum(axis=0), 0.0)
        open_ = np.sqrt(np.outer(left[ia], left[ib])) + SLACK
        live &= (dot + open_ >= low) & (dot - open_ <= high)
    i, j = np.nonzero(live)
    return _exact_rows(names, x, ia[i], ib[j])


def _listed_pairs(series: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Exact sums for the listed pairs of a (block, block) group."""
    if not len(series) or not len(pairs):
        return pd.DataFrame({"symbol_a": [], "symbol_b": [], "hi": np.zeros(0, np.int64), "lo": np.zeros(0, np.int64)})
    names, _, x = _histories(series)
    place = {s: k for k, s in enumerate(names)}
    known = pairs[pairs["symbol_a"].isin(place) & pairs["symbol_b"].isin(place)]
    a, b = (np.array([place[s] for s in known[c]], dtype=np.int64) for c in ("symbol_a", "symbol_b"))
    return _exact_rows(names, x, a, b)


def _series(r: DataFrame, day_span: int) -> DataFrame:
    """(symbol, span, s): a ticker's days of one date range as one array, at most ``day_span`` long."""
    return r.groupBy("symbol", F.floor(F.unix_date("date") / day_span).alias("span")).agg(
        F.array_sort(F.collect_list(F.struct(F.unix_date("date").alias("d"), F.col("x").alias("x")))).alias("s")
    )


def _least_blocks(r: DataFrame, parallelism: int | None) -> int:
    """Blocks whose pairs alone keep the stated parallelism (default: the session's) busy."""
    cores = parallelism or r.sparkSession.sparkContext.defaultParallelism
    return max(2, math.ceil(math.sqrt(2 * cores)))


def _block(symbol: str, nb: str = "nb") -> F.Column:
    return F.pmod(F.xxhash64(symbol), F.col(nb).cast("long")).cast("int")


def _paired(series: DataFrame) -> DataFrame:
    """Each series at every pair of blocks that its own belongs to."""
    return (
        series.withColumn("blk", _block("symbol"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select(
            F.least("blk", "other").alias("blk_lo"),
            F.greatest("blk", "other").alias("blk_hi"),
            "span",
            "blk",
            "symbol",
            F.col("s.d").alias("days"),
            F.col("s.x").alias("xs"),
        )
    )


def pair_groups(r: DataFrame, parallelism: int | None = None, day_span: int = DAY_SPAN) -> DataFrame:
    """The series as rows of (block, block, date range) groups.

    Blocks come from the stated parallelism and from the block size.
    """
    n_symbols = r.select(F.countDistinct("symbol")).scalar()
    nb = F.greatest(F.lit(_least_blocks(r, parallelism)), F.ceil(n_symbols / F.lit(BLOCK_TICKERS))).cast("int")
    return _paired(_series(r, day_span).withColumn("nb", nb))


def _whole_blocks(r: DataFrame, parallelism: int | None) -> F.Column:
    """Number of blocks if a group holds whole histories: fewer tickers a block the longer they are."""
    n_symbols, n_days = r.select(F.countDistinct("symbol")).scalar(), r.select(F.countDistinct("date")).scalar()
    per = F.greatest(F.lit(1), F.least(F.lit(BLOCK_TICKERS), F.floor(F.lit(BLOCK_CELLS) / F.greatest(n_days, F.lit(1)))))
    return F.greatest(F.lit(_least_blocks(r, parallelism)), F.ceil(n_symbols / per)).cast("int")


def _sum_of_words(hi: F.Column, lo: F.Column) -> F.Column:
    """Exact decimal(38,0) of summed words; a sum beyond it is an error in either ANSI mode."""
    total = exact(hi) * exact(F.lit(1 << WORD)) + exact(lo)
    return F.coalesce(exact(total), F.raise_error(F.lit("a sum of products passes decimal(38,0)")).cast("decimal(38,0)"))


def _product_sums(r: DataFrame, parallelism: int | None, day_span: int) -> DataFrame:
    """``(symbol_a, symbol_b, sab)`` for ``symbol_a <= symbol_b``, exact decimal(38,0)."""
    groups = pair_groups(r, parallelism, day_span).groupBy("blk_lo", "blk_hi", "span")
    sums = groups.applyInPandas(_block_pair_sums, schema=PAIR_SUMS_SCHEMA)
    total = sums.groupBy("symbol_a", "symbol_b").agg(F.sum(exact("hi")).alias("hi"), F.sum(exact("lo")).alias("lo"))
    return total.select("symbol_a", "symbol_b", _sum_of_words(F.col("hi"), F.col("lo")).alias("sab"))


def _product_sums_in_range(r: DataFrame, low: float, high: float, parallelism: int | None) -> DataFrame:
    """The same for pairs whose correlation can lie in ``[low, high]``; no other pair leaves its group."""
    groups = _paired(_series(r, DAY_SPAN).withColumn("nb", _whole_blocks(r, parallelism))).groupBy("blk_lo", "blk_hi")
    sums = groups.applyInPandas(lambda pdf: _pairs_in_range(pdf, low, high), schema=PAIR_SUMS_SCHEMA)
    return sums.select("symbol_a", "symbol_b", _sum_of_words(F.col("hi"), F.col("lo")).alias("sab"))


def _product_sums_listed(r: DataFrame, pairs: DataFrame, parallelism: int | None) -> DataFrame:
    """The same for the listed pairs ``(symbol_a, symbol_b)``; only blocks that hold such pairs meet."""
    nb = _whole_blocks(r, parallelism)
    listed = pairs.select("symbol_a", "symbol_b").distinct().withColumn("nb", nb)
    listed = listed.withColumn("p", _block("symbol_a")).withColumn("q", _block("symbol_b"))
    listed = listed.select("symbol_a", "symbol_b", F.least("p", "q").alias("blk_lo"), F.greatest("p", "q").alias("blk_hi"))
    named = listed.select(F.explode(F.array("symbol_a", "symbol_b")).alias("symbol"), F.col("blk_lo").alias("lo"), F.col("blk_hi").alias("hi")).distinct()
    series = _series(r, DAY_SPAN).join(named, "symbol").withColumn("nb", nb)
    series = series.select("lo", "hi", _block("symbol").alias("blk"), "symbol", F.col("s.d").alias("days"), F.col("s.x").alias("xs"))
    met = series.groupBy("lo", "hi").cogroup(listed.groupBy("blk_lo", "blk_hi"))
    sums = met.applyInPandas(_listed_pairs, schema=PAIR_SUMS_SCHEMA)
    return sums.select("symbol_a", "symbol_b", _sum_of_words(F.col("hi"), F.col("lo")).alias("sab"))


def _product_sums_join(r: DataFrame) -> DataFrame:
    """The same by a self-join on date (one row per date and pair; small universes only)."""
    a = r.select("date", F.col("symbol").alias("symbol_a"), F.col("x").alias("xa"))
    b = r.select("date", F.col("symbol").alias("symbol_b"), F.col("x").alias("xb"))
    j = a.join(b, "date").where(F.col("symbol_a") <= F.col("symbol_b"))
    return j.groupBy("symbol_a", "symbol_b").agg(F.sum(exact("xa") * F.col("xb")).alias("sab"))


def pair_moments(
    returns: DataFrame,
    decimals: int = 6,
    symbols: DataFrame | None = None,
    method: str = "blocked",
    parallelism: int | None = None,
    day_span: int = DAY_SPAN,
) -> DataFrame:
    """``(symbol_a, symbol_b, n, cov_num, var_a, var_b)`` for ``symbol_a <= symbol_b``.

    ``returns`` is complete-case (every ticker has the same dates; a pair whose
    counts differ is an error). With ``x``, ``y`` the integer units of the two
    returns: ``cov_num = n*sum(xy) - sum(x)*sum(y)``, ``var_a = n*sum(x^2) -
    sum(x)^2``; all exact decimal(38,0). ``method="join"`` is the plain self-join.
    """
    r = _units_frame(returns, decimals, symbols)
    m = _product_sums(r, parallelism, day_span) if method == "blocked" else _product_sums_join(r)
    return _moments(m, r)


def _moments(sums: DataFrame, r: DataFrame) -> DataFrame:
    squares = F.coalesce(F.sum(exact("x") * F.col("x")), F.raise_error(F.lit("a sum of squares passes decimal(38,0)")).cast("decimal(38,0)"))
    own = r.groupBy("symbol").agg(F.count("*").alias("n"), F.sum(exact("x")).alias("s"), squares.alias("ss"))
    a = own.select(F.col("symbol").alias("symbol_a"), F.col("n").alias("na"), F.col("s").alias("sa"), F.col("ss").alias("saa"))
    b = own.select(F.col("symbol").alias("symbol_b"), F.col("n").alias("nb"), F.col("s").alias("sb"), F.col("ss").alias("sbb"))
    same = F.when(F.col("na") == F.col("nb"), F.col("na")).otherwise(F.raise_error(F.lit("returns are not complete-case")).cast("bigint"))
    m = sums.join(a, "symbol_a").join(b, "symbol_b").withColumn("n", same)
    n = exact("n")
    return m.select(
        "symbol_a",
        "symbol_b",
        "n",
        (n * F.col("sab") - exact("sa") * exact("sb")).alias("cov_num"),
        (n * F.col("saa") - exact("sa") * exact("sa")).alias("var_a"),
        (n * F.col("sbb") - exact("sb") * exact("sb")).alias("var_b"),
    )


def correlation_half_in_range(
    returns: DataFrame, lo: float, hi: float, decimals: int = 2, ret_decimals: int = 6, parallelism: int | None = None
) -> DataFrame:
    """The rows of :func:`correlation_half` with ``lo <= corr <= hi``, without forming the other pairs.

    A group meets two blocks of whole histories and drops a pair as soon as its
    correlation cannot round into the interval; exact sums are taken for the
    pairs that are left, and those alone leave Python.
    """
    r = _units_frame(returns, ret_decimals, None)
    half_step = 0.5 * 10.0**-decimals
    m = _moments(_product_sums_in_range(r, lo - half_step, hi + half_step, parallelism), r)
    c = m.select("symbol_a", "symbol_b", F.round(pearson(m), decimals).alias("corr"))
    return c.where(F.col("corr").between(lo, hi))


def pair_covariance(returns: DataFrame, pairs: DataFrame, ret_decimals: int = 6, parallelism: int | None = None) -> DataFrame:
    """``(symbol_a, symbol_b, cov)`` of the listed pairs with ``symbol_a <= symbol_b``, each once.

    Only listed pairs are multiplied; a pair with a ticker that has no returns is left out.
    """
    r = _units_frame(returns, ret_decimals, None)
    m = _moments(_product_sums_listed(r, pairs, parallelism), r)
    return m.select("symbol_a", "symbol_b", _covariance_of(ret_decimals).alias("cov"))


def _covariance_of(ret_decimals: int) -> F.Column:
    nn = (F.col("n") * (F.col("n") - 1)).cast("double")
    return F.when(F.col("n") > 1, F.col("cov_num").cast("double") / nn / F.lit(10.0 ** (2 * ret_decimals)))


def mirror(half: DataFrame, value: str) -> DataFrame:
    """Full square matrix from the ``a <= b`` half, in one pass over it."""
    a, b, v = F.col("symbol_a"), F.col("symbol_b"), F.col(value)
    fwd = F.struct(a.alias("symbol_a"), b.alias("symbol_b"), v.alias(value))
    rev = F.struct(b.alias("symbol_a"), a.alias("symbol_b"), v.alias(value))
    both = F.when(a == b, F.array(fwd)).otherwise(F.array(fwd, rev))
    return half.select(F.inline(both))


def pearson(m: DataFrame) -> F.Column:
    den = F.sqrt(F.col("var_a").cast("double") * F.col("var_b").cast("double"))
    return F.when(den > 0, F.col("cov_num").cast("double") / den)


def correlation_half(
    returns: DataFrame, decimals: int = 2, ret_decimals: int = 6, symbols: DataFrame | None = None
) -> DataFrame:
    """Rounded Pearson correlations ``(symbol_a, symbol_b, corr)`` of the pairs ``symbol_a <= symbol_b``."""
    m = pair_moments(returns, ret_decimals, symbols)
    return m.select("symbol_a", "symbol_b", F.round(pearson(m), decimals).alias("corr"))


def correlation_matrix(
    returns: DataFrame, decimals: int = 2, ret_decimals: int = 6, symbols: DataFrame | None = None
) -> DataFrame:
    """Long Pearson matrix ``(symbol_a, symbol_b, corr)`` rounded to ``decimals``; diagonal included."""
    return mirror(correlation_half(returns, decimals, ret_decimals, symbols), "corr")


def correlation_wide(corr: DataFrame, symbols, name_col: str = "stockName") -> DataFrame:
    """Wide matrix view: one row per ticker (``stockName``) and one column per listed ticker."""
    return corr.groupBy(F.col("symbol_a").alias(name_col)).pivot("symbol_b", list(symbols)).agg(F.first("corr"))


def covariance(returns: DataFrame, ret_decimals: int = 6, symbols: DataFrame | None = None) -> DataFrame:
    """Sample covariance matrix ``(symbol_a, symbol_b, cov)``, full square."""
    m = pair_moments(returns, ret_decimals, symbols)
    return mirror(m.select("symbol_a", "symbol_b", _covariance_of(ret_decimals).alias("cov")), "cov")


def mean_returns(
    returns: DataFrame, decimals: int = 6, ret_decimals: int = 6, symbols: DataFrame | None = None
) -> DataFrame:
    """``(symbol, mean)``: average return rounded half-up to ``decimals``, exactly."""
    r = _units_frame(returns, ret_decimals, symbols)
    g = r.groupBy("symbol").agg(F.sum(exact("x")).alias("sx"), F.count("x").alias("n"))
    shift = decimals - ret_decimals
    num = F.col("sx") * F.lit(10 ** max(shift, 0))
    den = exact("n") * F.lit(10 ** max(-shift, 0))
    return g.select("symbol", scaled(div_half_up(num, den), decimals).alias("mean"))


def betas(
    returns: DataFrame, decimals: int = 2, ret_decimals: int = 6, symbols: DataFrame | None = None
) -> DataFrame:
    """``(symbol, beta)``: OLS slope with intercept of ``ret`` on ``index_ret``.

    Rounded half-up to ``decimals`` exactly; 0.0 when the index is constant.
    """
    return member_stats(returns, ret_decimals, decimals, ret_decimals, symbols).select("symbol", "beta")


def member_stats(
    returns: DataFrame,
    mean_decimals: int = 6,
    beta_decimals: int = 2,
    ret_decimals: int = 6,
    symbols: DataFrame | None = None,
) -> DataFrame:
    """``(symbol, mean, beta)`` from one grouped pass over the returns.

    Same values as :func:`mean_returns` and :func:`betas`, one shuffle for both.
    """
    r = returns.select(
        "symbol", units("ret", ret_decimals).alias("y"), units("index_ret", ret_decimals).alias("x")
    )
    if symbols is not None:
        r = r.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    g = r.groupBy("symbol").agg(
        F.count("*").alias("n"),
        F.sum("x").alias("sx"),
        F.sum(exact("y")).alias("sy"),
        F.sum(exact("x") * F.col("x")).alias("sxx"),
        F.sum(exact("x") * F.col("y")).alias("sxy"),
    )
    n = exact("n")
    shift = mean_decimals - ret_decimals
    mean_units = div_half_up(F.col("sy") * F.lit(10 ** max(shift, 0)), n * F.lit(10 ** max(-shift, 0)))
    cov_num = n * F.col("sxy") - exact("sx") * F.col("sy")
    var_x = n * F.col("sxx") - exact("sx") * exact("sx")
    beta_units = div_half_up(cov_num * F.lit(10**beta_decimals), var_x)
    return g.select(
        "symbol",
        scaled(mean_units, mean_decimals).alias("mean"),
        F.coalesce(scaled(beta_units, beta_decimals), F.lit(0.0)).alias("beta"),
    )


# group functions of this module run on executors: serialise them by value
ship_by_value(__name__)
