"""Surrogate-key lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def own_exchange(key: str) -> Column:
    """A join key equal to ``key`` that does not count as partitioned yet.

    A join that reuses the partitioning of an earlier step has no exchange on that side, and
    adaptive execution can only split a hot key where both sides have one. Use it for the
    small side of a join whose other side may be skewed.
    """
    return F.concat(F.col(key), F.lit(""))


def lookup_scd2(
    df: DataFrame,
    dim: DataFrame,
    business_key: str,
    on_date: str,
    *columns: str,
    inclusive: bool = False,
    how: str = "inner",
) -> DataFrame:
    """Attach ``columns`` of the dimension version valid on ``on_date``.

    The business key stays an equi-join key and the dates a residual condition, so the plan
    is a partitioned join in which adaptive execution can split a hot key. Ranges are
    half-open by default, so a day on which one version ends and the next begins matches
    once; ``inclusive=True`` matches both. ``how="left"`` keeps rows without a version.
    """
    versions = dim.select(
        F.col(business_key).alias("_business_key"),
        F.col("valid_from").alias("_valid_from"),
        F.col("valid_to").alias("_valid_to"),
        *columns,
    )
    day = F.to_date(F.col(on_date))
    ends = day <= F.col("_valid_to") if inclusive else day < F.col("_valid_to")
    matched = (F.col(business_key) == F.col("_business_key")) & (day >= F.col("_valid_from")) & ends
    return df.join(versions, matched, how).drop("_business_key", "_valid_from", "_valid_to")


def lookup(df: DataFrame, dim: DataFrame, business_key: str, *columns: str, how: str = "inner") -> DataFrame:
    """Attach ``columns`` of a one-row-per-key dimension.

    No broadcast hint: the optimizer broadcasts the dimension when its measured size is
    under the session threshold and shuffles both sides otherwise.
    """
    return df.join(dim.select(business_key, *columns), business_key, how)
