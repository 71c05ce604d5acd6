"""Ratios, rounding and money sums.

Divisions use ``try_divide``: a zero (or NULL) denominator gives NULL
instead of an error under ANSI mode or an infinity.

Rounding is ``round`` (HALF_UP on the decimal form of the double), the
same rule for every figure.

Money is summed without rounding any amount. An amount whose decimal text has
at most 12 digits after the point (and under 1e16 in size) is summed as
``decimal``: such a total does not depend on row order, partitioning or retries.
Every other amount (NaN, infinities, huge values, longer fractions) is summed as
the double it is, and that sum is added at the end, so NaN gives NaN and an
infinity an infinity. The decimal sum holds totals up to 1e26.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._cols import as_col

_EXACT = "decimal(28,12)"


def _exact(amount) -> tuple[Column, Column]:
    """The amount as an exact decimal (NULL where there is none), and whether
    there is one."""
    x = as_col(amount).cast("double")
    d = x.try_cast(_EXACT)
    return d, F.coalesce(d.cast("double") == x, F.lit(False))


def exact_part(amount) -> Column:
    """The amounts to sum as decimals."""
    d, ok = _exact(amount)
    return F.when(ok, d)


def double_part(amount) -> Column:
    """The amounts to sum as doubles: those without an exact decimal."""
    _, ok = _exact(amount)
    return F.when(~ok, as_col(amount).cast("double"))


def total(exact, rest) -> Column:
    """The two sums put together, as a double (NULL if both are)."""
    exact, rest = as_col(exact).cast("double"), as_col(rest)
    return F.when(rest.isNull(), exact).otherwise(rest + F.coalesce(exact, F.lit(0.0)))


def money_sum(amount) -> Column:
    """Sum of an amount column, as a double (see the module's notes)."""
    return total(F.sum(exact_part(amount)), F.sum(double_part(amount)))


def ratio(num, den, digits: int | None = 2) -> Column:
    """``num / den`` rounded; NULL when ``den`` is 0 or NULL."""
    r = F.try_divide(as_col(num), as_col(den))
    return r if digits is None else F.round(r, digits)


def pct(num, den, digits: int | None = 2) -> Column:
    """``num / den * 100`` rounded; NULL when ``den`` is 0."""
    r = F.try_divide(as_col(num), as_col(den)) * F.lit(100)
    return r if digits is None else F.round(r, digits)


def growth_pct(last, first) -> Column:
    """``(last / first - 1) * 100``, unrounded; NULL when ``first`` is 0
    (A8)."""
    return (F.try_divide(as_col(last), as_col(first)) - F.lit(1)) * F.lit(100)


def abs_change(last, first) -> Column:
    """``|last - first|``."""
    return F.abs(as_col(last) - as_col(first))
