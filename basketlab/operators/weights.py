"""Long-only minimum-variance weights of every basket.

Minimising the annualised risk ``sqrt(P * w'Sw)`` subject to ``0 <= w <= 1``
and ``sum(w) = 1`` is a convex quadratic programme. Its optimum is computed
exactly (up to float rounding) by an active-set method on the equivalent
non-negative problem ``min 1/2 x'Sx - 1'x, x >= 0``, ``w = x / sum(x)``.

Covariances come from the pairs that share a basket
(``stats.pair_covariance``); a basket becomes one row of at most ``max_size **
2`` values (the basket-size rule bounds it), dealt by the hash of its name, and
each Arrow batch solves its baskets of one size as one numpy stack, so there is
no Python group a basket. The active set grows and shrinks only while the
objective falls, which it can do for each of the finitely many sets once; the result is checked against the optimality
conditions and anything else is an error, as is a missing covariance. Weights
are rounded half-even to 2 decimals like ``numpy.round``; they are not
renormalised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.functions.shipping import ship_by_value

WEIGHTS_SCHEMA = "portfolio string, pos int, symbol string, weight_exact double, weight float"


def min_variance_qp(cov: np.ndarray, tol: float = 1e-12, check: float = 1e-7) -> np.ndarray:
    """Weights ``w >= 0``, ``sum(w) = 1`` minimising ``w' cov w`` of one matrix."""
    return min_variance_batch(cov[None], tol, check)[0]


def min_variance_batch(cov: np.ndarray, tol: float = 1e-12, check: float = 1e-7) -> np.ndarray:
    """The same for a stack ``(baskets, n, n)`` at once.

    Lawson-Hanson style active set on ``min 1/2 x'Qx - 1'x, x >= 0`` with
    ``Q`` the covariance scaled to unit mean diagonal plus a tiny ridge (keeps
    a singular matrix solvable and the answer deterministic). All baskets take
    their steps together: each solves on its own free places (the others hold
    unit rows), baskets that are done stand still. Raises if a covariance is
    not finite or the optimality conditions fail by ``check``.
    """
    m, n = cov.shape[:2]
    if n == 0 or m == 0:
        return np.zeros((m, n))
    if not np.isfinite(cov).all():
        raise ValueError("a covariance is missing")
    scale = np.trace(cov, axis1=1, axis2=2) / n
    flat = scale <= 0
    eye = np.eye(n)
    q = cov / np.where(flat, 1.0, scale)[:, None, None] + eye * 1e-12
    x, before, free, value = np.zeros((m, n)), np.zeros((m, n)), np.zeros((m, n), dtype=bool), np.zeros(m)
    moving, shrinking = ~flat, np.zeros(m, dtype=bool)
    while moving.any():
        # baskets at their optimum for the present places free one more, or are done
        grad = np.einsum("bij,bj->bi", q, x) - 1.0
        gain = np.where(~free & (grad < -tol), grad, np.inf)
        best = gain.argmin(axis=1)
        asks = moving & ~shrinking
        some = np.isfinite(gain[np.arange(m), best])
        moving &= ~(asks & ~some)
        start = np.flatnonzero(asks & some)
        before[start], free[start, best[start]], shrinking[start] = x[start], True, True
        # one step of those on the way; every step but the last frees at least one place less
        at = np.flatnonzero(moving & shrinking)
        f = free[at]
        z = np.linalg.solve(np.where(f[:, :, None] & f[:, None, :], q[at], eye), f[:, :, None].astype(float))[:, :, 0] * f
        low = f & (z <= tol)
        whole = ~low.any(axis=1)
        x[at[whole]] = z[whole]
        part, zp, lp = at[~whole], z[~whole], low[~whole]
        fall = x[part] - zp
        steps = np.where(lp, np.where(fall > 0, x[part] / np.where(fall > 0, fall, 1.0), 0.0), np.inf)
        xp = x[part] + steps.min(axis=1, initial=np.inf)[:, None] * (zp - x[part])
        fp = free[part] & (xp > tol)
        fp[np.arange(len(part)), steps.argmin(axis=1)] = False
        x[part], free[part] = np.where(fp, xp, 0.0), fp
        ended = np.concatenate([at[whole], part[~fp.any(axis=1)]])
        now = 0.5 * np.einsum("bi,bij,bj->b", x[ended], q[ended], x[ended]) - x[ended].sum(axis=1)
        stuck = now >= value[ended]  # no set is visited twice
        back = ended[now > value[ended]]
        x[back] = before[back]
        moving[ended[stuck]] = False
        value[ended], shrinking[ended] = now, False
    total = x.sum(axis=1)
    if (total[~flat] <= 0).any():
        raise ValueError("the covariance is not positive semidefinite")
    w = np.where(flat[:, None], 1.0 / n, x / np.where(flat, 1.0, total)[:, None])
    grad = np.einsum("bij,bj->bi", q, w)
    level = (w * grad).sum(axis=1, keepdims=True)
    near = check * np.maximum(1.0, np.abs(level))
    wrong = np.where(w > 0, np.abs(grad - level) > near, grad < level - near)
    if wrong[~flat].any():
        raise ValueError("the solver did not reach the optimum")
    return w


def _solve_batches(batches: Iterator[pd.DataFrame], decimals: int) -> Iterator[pd.DataFrame]:
    """One row a basket in, one row a member out; baskets of one size are solved as one stack."""
    for pdf in batches:
        out = []
        for n, part in pdf.groupby("n"):
            n = int(n)
            w = min_variance_batch(np.stack([np.asarray(c, dtype=float).reshape(n, n) for c in part["cov"]]))
            out.append(
                pd.DataFrame(
                    {
                        "portfolio": np.repeat(part["portfolio"].to_numpy(dtype=object), n),
                        "pos": np.concatenate([np.asarray(p, dtype=np.int32) for p in part["pos"]]),
                        "symbol": np.concatenate([np.asarray(s, dtype=object) for s in part["symbols"]]),
                        "weight_exact": w.ravel(),
                        "weight": np.round(w.ravel(), decimals).astype("float32"),
                    }
                )
            )
        if out:
            yield pd.concat(out)


def basket_pairs(baskets: DataFrame) -> DataFrame:
    """Distinct ``(symbol_a, symbol_b)``, ``symbol_a <= symbol_b``, that share a basket; at most sum(n**2) rows."""
    a = baskets.select("portfolio", F.col("symbol").alias("symbol_a"))
    b = baskets.select("portfolio", F.col("symbol").alias("symbol_b"))
    return a.join(b, "portfolio").where("symbol_a <= symbol_b").select("symbol_a", "symbol_b").distinct()


def basket_cov_blocks(baskets: DataFrame, cov: DataFrame) -> DataFrame:
    """``(portfolio, n, pos, symbols, cov)``: a basket's members in order and its covariances row by row.

    ``cov`` needs the pairs with ``symbol_a <= symbol_b`` only. Arrays hold at
    most ``max_size`` and ``max_size**2`` values.
    """
    a = baskets.select("portfolio", F.col("pos").alias("pos_a"), F.col("symbol").alias("sa"))
    b = baskets.select("portfolio", F.col("pos").alias("pos_b"), F.col("symbol").alias("sb"))
    both = a.join(b, "portfolio").withColumn("symbol_a", F.least("sa", "sb")).withColumn("symbol_b", F.greatest("sa", "sb"))
    cells = both.join(cov.where("symbol_a <= symbol_b"), ["symbol_a", "symbol_b"], "left")
    cell = F.struct("pos_a", "pos_b", F.col("sa").alias("symbol"), F.coalesce("cov", F.lit(float("nan"))).alias("cov"))
    rows = cells.groupBy("portfolio").agg(F.array_sort(F.collect_list(cell)).alias("c"))
    firsts = F.filter("c", lambda x, i: F.pmod(i, F.sqrt(F.size("c")).cast("int")) == 0)
    return rows.select("portfolio", F.size(firsts).alias("n"), firsts["pos_a"].alias("pos"), firsts["symbol"].alias("symbols"), F.col("c.cov").alias("cov"))


def min_variance_weights(baskets: DataFrame, cov: DataFrame, decimals: int = 2) -> DataFrame:
    """``(portfolio, pos, symbol, weight_exact double, weight float)`` from given covariances."""
    blocks = basket_cov_blocks(baskets, cov)
    return blocks.mapInPandas(lambda batches: _solve_batches(batches, decimals), schema=WEIGHTS_SCHEMA)


# group functions of this module run on executors: serialise them by value
ship_by_value(__name__)
