"""Aggregation helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import percent
from tillstar.operators.keys import stored_once


def group_with_distincts(
    df: DataFrame,
    group: Sequence[str],
    measures: Mapping[str, Column],
    distincts: Mapping[str, str],
) -> DataFrame:
    """Grouped measures plus several exact distinct counts, from one scan.

    Each row is tagged once for every distinct column and once for the measures; tagged values are combined on the map side, so
    a value travels once per task, and the shuffle spreads a hot group over its values. Only the
    columns asked for are copied.
    """
    needed = df if not distincts else df.withColumns({f"_of_{n}": F.col(c) for n, c in distincts.items()})
    counts = [F.count_distinct(F.col(f"_of_{n}")).alias(n) for n in distincts]
    return needed.groupBy(*group).agg(*[c.alias(n) for n, c in measures.items()], *counts)


# Relative error of a distinct count from sketches is about 0.8 / sqrt(2^LG_K) at one standard deviation.
LG_K = 14


def day_sketches(df: DataFrame, day: str, group: Sequence[str], distincts: Mapping[str, str], lg_k: int = LG_K) -> DataFrame:
    """A mergeable sketch of distinct values for each group and day: what a load adds, to be appended to what is stored."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(n) for n, c in distincts.items()]
    return df.groupBy(*group, day).agg(*sketches)


def distincts_of(sketches: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct counts over any days of stored sketches, without the rows they came from."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names]
    return sketches.groupBy(*group).agg(*merged)


def share_of_total(grouped: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``value`` as a percentage of its total over all groups.

    The grouped rows are stored once and the total is a scalar subquery over the stored
    rows: the fact is read once, and no task has to hold all groups.
    """
    kept = stored_once(grouped, "shares")
    return kept.withColumn(name, percent(F.col(value), kept.agg(F.sum(value)).scalar()))


def exact_mean(value: Column, digits: int = 6) -> Column:
    """Mean of a double column from whole units of 10^-digits, so that the sum does not
    depend on the order in which tasks finish."""
    scale = float(10**digits)
    units = F.signum(value) * F.floor(F.abs(value) * F.lit(scale) + F.lit(0.5))
    total = F.sum(units.cast("decimal(28,0)")).cast("double")
    return total / F.lit(scale) / F.when(F.count(value) > 0, F.count(value).cast("double"))
