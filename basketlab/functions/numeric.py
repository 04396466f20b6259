"""Column expressions for exact, order-independent arithmetic.

Returns are rounded to a fixed number of decimals before any statistic is
taken, so each one is an exact integer count of ``10**-decimals`` units. Sums
of those integers (and of their products) are exact, hence identical for any
partitioning, task order or retry, and the only floating-point steps are the
final combinations. Everything here is a built-in Spark expression, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for sums of squared micro-unit returns over any realistic history.
EXACT = "decimal(38,0)"


def units(col: Column | str, decimals: int) -> Column:
    """Exact integer units of an already rounded double (``0.012345`` -> 12345)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(10.0**decimals)).cast("bigint")


def exact(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(EXACT)


def int_div(num: Column, den: Column) -> Column:
    """Integral quotient truncated toward zero (Spark ``div``); null when den is 0."""
    return F.call_function("div", num, den)


def div_half_up(num: Column, den: Column) -> Column:
    """``num / den`` rounded half away from zero to an integer, exactly.

    Operands are integral (bigint or decimal(38,0)); null when ``den`` is 0.
    """
    q = int_div(F.abs(num) * 2 + F.abs(den), F.abs(den) * 2)
    return F.when(den == 0, F.lit(None)).otherwise(q * F.signum(num) * F.signum(den)).cast("bigint")


def scaled(units_col: Column, decimals: int) -> Column:
    """Integer units back to the nearest double (``12345`` at 6 dp -> 0.012345)."""
    return units_col.cast("double") / F.lit(10.0**decimals)


def simple_return(price: Column, prev_price: Column) -> Column:
    """One-step return with the original batch's null rules.

    ``coalesce(p - prev, 0) / prev``: a missing price today gives 0, a missing
    or zero price yesterday gives null.
    """
    diff = price - prev_price
    return F.try_divide(F.when(F.isnull(diff), F.lit(0.0)).otherwise(diff), prev_price)
