"""Date keys, spans and period ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar.functions.numeric import _col


def date_key(value: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    d = _col(value)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_key(value: Column | str) -> Column:
    """YYYYMM as an integer."""
    d = _col(value)
    return F.year(d) * 100 + F.month(d)


def full_years(start: Column | str, end: Column | str) -> Column:
    """Completed years: the year difference, less one while the anniversary is still ahead."""
    s, e = _col(start), _col(end)
    ahead = (F.month(e) * 100 + F.dayofmonth(e)) < (F.month(s) * 100 + F.dayofmonth(s))
    return F.year(e) - F.year(s) - ahead.cast("int")


def whole_year_age(born: Column | str, as_of: Column | str) -> Column:
    """Age in blocks of 365 days, rounded down."""
    return F.floor(F.date_diff(_col(as_of), _col(born)) / F.lit(365.0)).cast("int")


def quarter_end(value: Column | str) -> Column:
    return F.date_sub(F.add_months(F.trunc(_col(value), "quarter"), 3), 1)
