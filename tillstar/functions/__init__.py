"""Column helpers: numbers, dates, text and bins."""

from tillstar.functions.bins import age_group, binned, score_band, tier
from tillstar.functions.calendar import date_key, full_years, month_key, quarter_end, whole_year_age
from tillstar.functions.numeric import decimal_sum, mean, percent, ratio, rounded, row_count
from tillstar.functions.text import clipped, padded_id, row_hash

__all__ = [
    "age_group", "binned", "clipped", "date_key", "decimal_sum", "full_years", "mean", "month_key",
    "padded_id", "percent", "quarter_end", "ratio", "rounded", "row_count", "row_hash", "score_band", "tier",
    "whole_year_age",
]
