"""Banding of numbers into labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar.functions.numeric import _col

# Bin edges and labels.
AGE_EDGES = (0, 25, 35, 45, 55, 65, 100)
AGE_LABELS = ("18-25", "26-35", "36-45", "46-55", "56-65", "65+")
VALUE_TIERS = ((10000, "VIP"), (5000, "High Value"), (1000, "Medium Value"))
VALUE_TIER_REST = "Low Value"
CLV_TIERS = ((5000, "High CLV"), (1000, "Medium CLV"))
CLV_TIER_REST = "Low CLV"
SCORE_BANDS = ((95, "EXCELLENT"), (80, "GOOD"), (60, "FAIR"))
SCORE_BAND_REST = "NEEDS ATTENTION"


def binned(value: Column | str, edges: Sequence[float], labels: Sequence[str], outside: str) -> Column:
    """Label of the interval (low, high] holding the value; anything else gets ``outside``."""
    v = _col(value)
    low = edges[0]
    picked = F.when(v.isNull() | (v <= low), F.lit(outside))
    for high, label in zip(edges[1:], labels):
        picked = picked.when(v <= high, F.lit(label))
    return picked.otherwise(F.lit(outside))


def age_group(age: Column | str) -> Column:
    return binned(age, AGE_EDGES, AGE_LABELS, "nan")


def tier(value: Column | str, floors: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the highest floor the value reaches."""
    v = _col(value)
    picked = None
    for floor, label in floors:
        picked = F.when(v >= floor, F.lit(label)) if picked is None else picked.when(v >= floor, F.lit(label))
    return picked.otherwise(F.lit(rest))


def score_band(score: Column | str) -> Column:
    return tier(score, SCORE_BANDS, SCORE_BAND_REST)
