"""Guarded ratios and one rounding rule, all built from native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rounded(value: Column | str, digits: int = 2) -> Column:
    """Half-up rounding away from zero, in plain double arithmetic."""
    x = _col(value).cast("double")
    scale = float(10**digits)
    return F.signum(x) * (F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double quotient; a zero or missing denominator gives NULL."""
    d = _col(den).cast("double")
    return _col(num).cast("double") / F.when(d != 0, d)


def percent(num: Column | str, den: Column | str, digits: int | None = 2) -> Column:
    value = _col(num).cast("double") * F.lit(100.0) / F.when(_col(den).cast("double") != 0, _col(den).cast("double"))
    return value if digits is None else rounded(value, digits)


def decimal_sum(value: Column | str) -> Column:
    """Exact money total, independent of summation order, wide enough for 10^14 lines of any amount."""
    return F.sum(value).cast("decimal(28,2)")


def mean(value: Column | str) -> Column:
    """Average as exact sum over non-null count."""
    return ratio(F.sum(value), F.count(value))


def row_count() -> Column:
    return F.count(F.lit(1))
