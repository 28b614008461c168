"""Text helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar.functions.numeric import _col

NULL_TOKEN = "<null>"


def row_hash(columns: Sequence[str]) -> Column:
    """MD5 of the pipe-joined source values.

    Only the given source columns take part, so the hash is stable across loads, and a
    missing value has its own token, so ('a', NULL) and (NULL, 'a') differ.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def clipped(value: Column | str, width: int) -> Column:
    return F.substring(_col(value), 1, width)


def padded_id(prefix: str, number: Column | str, width: int = 8) -> Column:
    """Prefix plus a zero-padded number; numbers wider than the pad keep all their digits."""
    digits = _col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))
