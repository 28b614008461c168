"""Slowly changing dimensions as set operations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.keys import stored_once, with_keys
from tillstar.operators.rows import differs, not_yet_in

OPEN_END = dt.date(9999, 12, 31)


def scd1_upsert(
    target: DataFrame, source: DataFrame, business_key: str, surrogate: str, overwrite: Sequence[str]
) -> DataFrame:
    """Overwrite the listed attributes of known keys and add unknown keys.

    Surrogate keys of known rows stay; new rows continue after the highest key. Rows of the
    target that the source does not mention are kept as they are.
    """
    s = source.select(F.col(business_key).alias("_id"), *[F.col(c).alias(f"_new_{c}") for c in overwrite])
    joined = target.join(s, F.col(business_key) == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    kept = joined.select(
        *[
            F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in overwrite else F.col(c)
            for c in target.columns
        ]
    )
    return kept.unionByName(append_new(target, source, business_key, surrogate))


def append_new(target: DataFrame, source: DataFrame, business_key: str, surrogate: str) -> DataFrame:
    """The source rows with unknown business keys, keyed after the target's highest key."""
    fresh = not_yet_in(source, target, [business_key])
    start = F.coalesce(target.agg(F.max(surrogate)).scalar(), F.lit(0)) + 1
    return with_keys(fresh, surrogate, [business_key], start).select(*target.columns)


class Scd2Result(NamedTuple):
    dim: DataFrame
    changes: DataFrame


def classify(
    current: DataFrame, staged: DataFrame, business_key: str, tracked: Sequence[str], in_place: Sequence[str]
) -> DataFrame:
    """Label every staged key ``new``, ``scd2_changed``, ``type1_changed`` or ``unchanged``."""
    columns = [*tracked, *in_place]
    old = current.select(F.col(business_key).alias("_id"), *[F.col(c).alias(f"_old_{c}") for c in columns])
    changed = differs([(F.col(c), F.col(f"_old_{c}")) for c in tracked])
    touched = differs([(F.col(c), F.col(f"_old_{c}")) for c in in_place])
    label = (
        F.when(F.col("_id").isNull(), "new")
        .when(changed, "scd2_changed")
        .when(touched, "type1_changed")
        .otherwise("unchanged")
    )
    return (
        staged.join(old, F.col(business_key) == F.col("_id"), "left")
        .withColumn("change", label)
        .drop("_id", *[f"_old_{c}" for c in columns])
    )


def expire(joined: DataFrame, as_of: dt.date) -> DataFrame:
    """Close the versions labelled ``scd2_changed``."""
    closing = F.coalesce(F.col("change") == "scd2_changed", F.lit(False))
    return joined.withColumns(
        {
            "valid_to": F.when(closing, F.lit(as_of)).otherwise(F.col("valid_to")),
            "is_current": F.when(closing, F.lit(False)).otherwise(F.col("is_current")),
        }
    )


def overwrite_in_place(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Take the staged value of ``columns`` for versions labelled ``type1_changed``."""
    touched = F.coalesce(F.col("change") == "type1_changed", F.lit(False))
    return joined.withColumns({c: F.when(touched, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns})


def new_versions(classified: DataFrame, as_of: dt.date, first_valid_from: str) -> DataFrame:
    """Open versions for new keys (from their own start date) and changed keys (from as_of)."""
    start = F.when(F.col("change") == "new", F.col(first_valid_from)).otherwise(F.lit(as_of))
    return (
        classified.filter(F.col("change").isin("new", "scd2_changed"))
        .withColumns({"valid_from": start, "valid_to": F.lit(OPEN_END), "is_current": F.lit(True)})
        .drop("change")
    )


def scd2_merge(
    dim: DataFrame,
    staged: DataFrame,
    as_of: dt.date,
    *,
    business_key: str,
    surrogate: str,
    tracked: Sequence[str],
    in_place: Sequence[str],
    first_valid_from: str,
) -> Scd2Result:
    """Merge one snapshot (one row per key) into a versioned dimension.

    Staged keys are compared with the current versions once and stored with their label.
    History is copied; current versions are expired or updated in place by a join on the
    business key; new versions are added with keys above the highest existing one. All
    comparisons are null-safe, and a version whose ``is_current`` is missing is history. A
    version that changed may not start after ``as_of``. Also returns the number of keys per change label.
    """
    current = F.coalesce("is_current", F.lit(False))
    classified = stored_once(classify(dim.filter(current), staged, business_key, tracked, in_place), "changes")
    # unchanged keys, usually almost all, need no join: their versions stay as they are
    verdict = classified.filter(F.col("change").isin("scd2_changed", "type1_changed")).select(
        F.col(business_key).alias("_id"), "change", *[F.col(c).alias(f"_new_{c}") for c in in_place]
    )
    later = dim.filter(current & (F.col("valid_from") > F.lit(as_of)))
    changed = verdict.filter("change = 'scd2_changed'")
    if not later.join(changed, F.col(business_key) == F.col("_id"), "left_semi").isEmpty():
        raise ValueError(f"a changed version starts after {as_of} and cannot end then")
    carried = (
        dim.filter(current)
        .join(verdict, F.col(business_key) == F.col("_id"), "left")
        .transform(expire, as_of)
        .transform(overwrite_in_place, in_place)
        .select(*dim.columns)
    )
    opened = new_versions(classified, as_of, first_valid_from)
    start = F.coalesce(dim.agg(F.max(surrogate)).scalar(), F.lit(0)) + 1
    keyed = with_keys(opened, surrogate, [business_key], start)
    defaults = {c: F.lit(0) for c in ("lifetime_value", "total_orders", "total_spent") if c in dim.columns}
    added = keyed.withColumns(defaults).select(*[F.col(f.name).cast(f.dataType) for f in dim.schema])
    merged = dim.filter(~current).unionByName(carried).unionByName(added)
    changes = classified.groupBy("change").agg(F.count(F.lit(1)).alias("customers"))
    return Scd2Result(merged, changes)


class Scd2Delta(NamedTuple):
    """What a snapshot changes: ``changed`` keys, ``carried`` (stored versions with their changes), ``added`` versions, keys per label."""

    changed: DataFrame
    carried: Callable[[DataFrame], DataFrame]
    added: DataFrame
    changes: DataFrame


def scd2_delta(
    current: DataFrame,
    staged: DataFrame,
    as_of: dt.date,
    *,
    business_key: str,
    surrogate: str,
    highest: int,
    tracked: Sequence[str],
    in_place: Sequence[str],
    first_valid_from: str,
) -> Scd2Delta:
    """The same merge as ``scd2_merge`` from current versions alone, for a dimension that is not written whole.

    ``highest`` is the highest surrogate key in force. ``carried`` closes or updates those of the versions it is given that
    the snapshot changes; versions of keys that are not in ``changed`` need not be given to it.
    """
    classified = stored_once(classify(current, staged, business_key, tracked, in_place), "changes")
    changed = classified.filter(F.col("change") != "unchanged")
    verdict = changed.filter(F.col("change") != "new").select(
        F.col(business_key).alias("_id"), "change", *[F.col(c).alias(f"_new_{c}") for c in in_place])
    closing = verdict.filter("change = 'scd2_changed'")
    later = current.filter(F.col("valid_from") > F.lit(as_of))
    if not later.join(closing, F.col(business_key) == F.col("_id"), "left_semi").isEmpty():
        raise ValueError(f"a changed version starts after {as_of} and cannot end then")

    def carried(versions: DataFrame) -> DataFrame:
        return (
            versions.join(verdict, F.col(business_key) == F.col("_id"), "left")
            .transform(expire, as_of).transform(overwrite_in_place, in_place).select(*versions.columns))

    keyed = with_keys(new_versions(classified, as_of, first_valid_from), surrogate, [business_key], highest + 1)
    defaults = {c: F.lit(0) for c in ("lifetime_value", "total_orders", "total_spent") if c in current.columns}
    added = keyed.withColumns(defaults).select(*[F.col(f.name).cast(f.dataType) for f in current.schema])
    return Scd2Delta(changed, carried, added, classified.groupBy("change").agg(F.count(F.lit(1)).alias("customers")))
