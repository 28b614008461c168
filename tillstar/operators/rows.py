"""Keep-latest, upserts, anti/semi selection and null-safe comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.keys import stored_once, with_scan_position

# Keys with copies up to which only their rows are ranked.
MOST_REPEATED = 1_000_000


def keep_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``newest_first`` order.

    ``row_number() = 1`` lets the optimizer trim every map task to one row per key before
    the shuffle, so a key with very many copies does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def _load_order(df: DataFrame, key: str) -> list[Column]:
    """Newest load first. Rows of one load are told apart by their row hash, or by all their
    columns where there is none."""
    newest = [F.col(c).desc_nulls_last() for c in ("load_timestamp", "load_id") if c in df.columns]
    rest = ["row_hash"] if "row_hash" in df.columns else [c for c in df.columns if c != key]
    return newest + [F.col(c).asc_nulls_last() for c in rest]


def latest_load(df: DataFrame, key: str) -> DataFrame:
    """Latest staged row per business key; rows without the key are dropped."""
    return keep_latest(df.filter(F.col(key).isNotNull()), [key], _load_order(df, key))


def latest_of_copies(df: DataFrame, key: str) -> DataFrame:
    """The same rows as ``latest_load``, for a table in which few keys have copies.

    Keys are counted first and those with copies are stored. Only their rows are ranked; all others are neither
    sorted nor shuffled, and what tells copies apart is not computed for them. ``df`` is read twice.
    """
    present = df.filter(F.col(key).isNotNull())
    counted = present.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = stored_once(counted.filter("_rows > 1").select(key), "repeated")
    copies = repeated.count()
    if copies == 0:
        return present
    if copies > MOST_REPEATED:
        return latest_load(df, key)
    return not_yet_in(present, repeated, [key]).unionByName(latest_load(already_in(present, repeated, [key]), key))


def dedupe_staged(
    df: DataFrame, key: str, position: str | None = None, within: DataFrame | None = None
) -> DataFrame:
    """Latest staged row per key, with rows lacking the key passed through untouched.

    Both halves filter the scan on the key, so row groups without (or with only) missing
    keys are skipped by their statistics. ``position`` names a column to number the scanned
    rows with. ``within`` holds keys, under its column names, to which rows are reduced before
    they are ranked.
    """
    keyed, unkeyed = df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())
    if position:
        keyed, unkeyed = with_scan_position(keyed, position), with_scan_position(unkeyed, position)
    if within is not None:
        keyed, unkeyed = already_in(keyed, within, within.columns), already_in(unkeyed, within, within.columns)
    return keep_latest(keyed, [key], _load_order(df, key)).unionByName(unkeyed)


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True when any pair differs; NULL equals NULL."""
    return reduce(lambda a, b: a | b, (~left.eqNullSafe(right) for left, right in pairs), F.lit(False))


def _keys_of(existing: DataFrame, keys: Sequence[str], repeated: bool) -> DataFrame:
    picked = existing.select(*keys)
    return picked.distinct() if repeated else picked


def not_yet_in(df: DataFrame, existing: DataFrame, keys: Sequence[str], repeated: bool = False) -> DataFrame:
    """Rows whose key does not occur in ``existing``.

    Set ``repeated`` when keys occur many times there: copies are then combined on the map
    side, in the partitioning the join needs anyway, and a hot key travels once per task.
    """
    return df.join(_keys_of(existing, keys, repeated), list(keys), "left_anti")


def already_in(df: DataFrame, existing: DataFrame, keys: Sequence[str], repeated: bool = False) -> DataFrame:
    """Rows whose key occurs in ``existing``; ``repeated`` as for ``not_yet_in``."""
    return df.join(_keys_of(existing, keys, repeated), list(keys), "left_semi")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert or replace whole rows by key. ``source`` must hold each key once."""
    return not_yet_in(target, source, keys).unionByName(source, allowMissingColumns=True)


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows with unseen keys and leave existing rows alone."""
    return target.unionByName(not_yet_in(source, target, keys), allowMissingColumns=True)
