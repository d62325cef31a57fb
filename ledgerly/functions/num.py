"""Numeric helpers that pin down null, zero and rounding behaviour.

Money enters as ``DECIMAL(18,2)`` so sums are exact and independent of the
order Spark adds partial aggregates in. Ratios are computed in ``DOUBLE`` with
one division, then rounded with :func:`round2`, which is the same four IEEE
operations on every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c) -> Column:
    """Cast to the money type (2 decimals, exact sums)."""
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def dbl(c) -> Column:
    return F.col(c).cast("double") if isinstance(c, str) else c.cast("double")


def js_or(x, fallback) -> Column:
    """``parseFloat(x) || y``: null, NaN and zero all fall through."""
    x = F.col(x) if isinstance(x, str) else x
    fallback = F.lit(fallback) if not isinstance(fallback, Column) else fallback
    v = x.cast("string").try_cast("double")
    return F.coalesce(F.when(~F.isnan(v) & (v != 0), v), fallback)


def round2(c) -> Column:
    """``Math.round(v*100)/100``: ties go toward +infinity."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.floor(c.cast("double") * 100 + 0.5) / 100).cast("double")


def round_dec(c, scale: int = 2) -> Column:
    """SQL ``round(numeric, n)``: ties away from zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, scale)


def safe_div(a, b, default=0.0) -> Column:
    """Division guarded like ``NULLIF``/ternary: zero or null divisor -> default."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(default))


def ratio(num, den) -> Column:
    """Division that stays null when the divisor is zero or null."""
    a = F.col(num) if isinstance(num, str) else num
    b = F.col(den) if isinstance(den, str) else den
    return F.try_divide(a.cast("double"), b.cast("double"))


def signed(amount, is_positive: Column) -> Column:
    """PJ-3: revenue positive, everything else negative."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return F.when(is_positive, a).otherwise(-a)
