"""Column profiles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions import clipped, percent, ratio, rounded
from tillstar.sources.tables import TableStore

COLUMNS = (
    "table_name", "column_name", "profile_date", "total_rows", "null_count", "null_percentage", "distinct_count", "min_value",
    "max_value", "avg_value", "most_frequent_value", "data_type")


# Error of a distinct count: about 0.8 / sqrt(2^LG_K), of a quantile's rank: below 1.7 / K, of a frequency: below rows * 3.5 / ITEMS.
LG_K, K, ITEMS = 14, 400, 8192
PROFILE = "stg_data_profile"


def profile(df: DataFrame, table: str, profile_date: dt.date, approximate: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, min, max, mean, most frequent value.

    Counts, bounds and means come from one aggregate over the table. Values are counted on
    an unpivoted (column, value) stream that is combined before its shuffle; it yields the
    exact distinct count and the mode (ties go to the smallest value). ``approximate=True`` takes both from
    sketches in the one aggregate instead: no value is shuffled.
    """
    if approximate:
        return estimated(sketches(df), table, profile_date)
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    stats, records = [F.count(F.lit(1)).alias("_rows")], []
    for i, field in enumerate(df.schema):
        c = F.col(field.name)
        is_bool = isinstance(field.dataType, T.BooleanType)
        bound = c.cast("int") if is_bool else c
        stats += [
            F.count(c).alias(f"_n{i}"),
            F.min(bound).cast("string").alias(f"_lo{i}"),
            F.max(bound).cast("string").alias(f"_hi{i}"),
        ]
        if field.name in numeric:
            # exact for whole numbers and decimals; floating values keep all their digits
            exact = c.cast("decimal(38,4)") if not isinstance(field.dataType, (T.FloatType, T.DoubleType)) else c.cast("double")
            stats.append(F.sum(exact).alias(f"_sum{i}"))
        records.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("total_rows"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
                F.col(f"_lo{i}").alias("min_value"),
                F.col(f"_hi{i}").alias("max_value"),
                (ratio(f"_sum{i}", f"_n{i}") if field.name in numeric else F.lit(None).cast("double")).alias("avg_value"),
            )
        )
    summary = df.agg(*stats).select(F.inline(F.array(*records)))

    cells = F.array(
        *[F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_value")) for c in df.columns]
    )
    counted = (
        df.select(F.inline(cells)).filter(F.col("_value").isNotNull())
        .groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_count"))
    )
    modes = counted.groupBy("_column").agg(
        F.count(F.lit(1)).alias("_distinct"),
        F.min_by("_value", F.struct(-F.col("_count"), F.col("_value"))).alias("most_frequent_value"),
    )
    return (
        summary.join(modes, F.col("column_name") == F.col("_column"), "left")
        .select(
            F.lit(table).alias("table_name"),
            "column_name",
            F.lit(profile_date).alias("profile_date"),
            "total_rows",
            "null_count",
            F.coalesce(percent("null_count", "total_rows"), F.lit(0.0)).alias("null_percentage"),
            F.coalesce("_distinct", F.lit(0)).alias("distinct_count"),
            "min_value",
            "max_value",
            "avg_value",
            "most_frequent_value",
            "data_type",
        )
    )


def sketches(df: DataFrame) -> DataFrame:
    """One row per column with mergeable sketches of it, from one aggregate over the table.

    Rows, values, bounds, sum, a sketch of distinct values (HyperLogLog), one of the distribution of numbers (KLL) and one of frequent
    values. What leaves a task is a few sketches of bounded size for each column, whatever the rows.
    """
    stats, records = [F.count(F.lit(1)).alias("_rows")], []
    for i, field in enumerate(df.schema):
        c, text = F.col(f"`{field.name}`"), F.col(f"`{field.name}`").cast("string")
        number = isinstance(field.dataType, T.NumericType)
        if isinstance(field.dataType, T.BooleanType):
            order = c.cast("int").cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            order = c.cast("timestamp").cast("double")
        else:
            order = c.cast("double") if number else F.lit(None).cast("double")
        # numbers and times in their own order, texts in theirs
        bound = F.when(c.isNotNull(), F.struct(order.alias("order"), _as_bound(field, c).alias("text")))
        stats += [
            F.count(c).alias(f"_n{i}"), F.min(bound).alias(f"_lo{i}"), F.max(bound).alias(f"_hi{i}"),
            (F.sum(c.cast("decimal(38,4)")) if number else F.max(F.lit(None).cast("decimal(38,4)"))).cast("decimal(38,4)").alias(f"_sum{i}"),
            F.hll_sketch_agg(text, F.lit(LG_K)).alias(f"_hll{i}"),
            F.expr(f"approx_top_k_accumulate(cast(`{field.name}` as string), {ITEMS})").alias(f"_top{i}"),
            (F.expr(f"kll_sketch_agg_double(cast(`{field.name}` as double), {K})") if number
             else F.max(F.lit(None).cast("binary"))).alias(f"_kll{i}"),
        ]
        records.append(F.struct(
            F.lit(field.name).alias("column_name"), F.lit(i).alias("position"), F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col("_rows").alias("rows"), *[F.col(f"_{n}{i}").alias(n) for n in ("n", "lo", "hi", "sum", "hll", "top", "kll")]))
    return df.agg(*stats).select(F.inline(F.array(*records)))


def _as_bound(field: T.StructField, c: Column) -> Column:
    return (c.cast("int") if isinstance(field.dataType, T.BooleanType) else c).cast("string")


def merged(parts: DataFrame) -> DataFrame:
    """Sketches of the whole from sketches of its parts."""
    return parts.groupBy("column_name", "position", "data_type").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum("sum").cast("decimal(38,4)").alias("sum"), F.hll_union_agg("hll").alias("hll"),
        F.expr(f"approx_top_k_combine(top, {ITEMS})").alias("top"),
        F.when(F.count("kll") > 0, F.expr(f"kll_merge_agg_double(kll, {K})")).alias("kll"))


def estimated(found: DataFrame, table: str, profile_date: dt.date) -> DataFrame:
    """The columns of a profile from sketches. Of equally frequent values the smallest of those the sketch tracks is named."""
    items = F.expr("approx_top_k_estimate(top, 100)")
    top = F.filter("_items", lambda x: x["item"].isNotNull())
    most = F.array_max(F.transform(top, lambda x: x["count"]))
    return found.withColumn("_items", items).select(
        F.lit(table).alias("table_name"), "column_name", F.lit(profile_date).alias("profile_date"),
        F.col("rows").alias("total_rows"), (F.col("rows") - F.col("n")).alias("null_count"),
        F.coalesce(percent(F.col("rows") - F.col("n"), "rows"), F.lit(0.0)).alias("null_percentage"),
        F.hll_sketch_estimate("hll").alias("distinct_count"), F.col("lo.text").alias("min_value"), F.col("hi.text").alias("max_value"),
        ratio("sum", "n").alias("avg_value"),
        F.array_min(F.transform(F.filter(top, lambda x: x["count"] == most), lambda x: x["item"])).alias("most_frequent_value"),
        "data_type")


def quantiles(found: DataFrame, ranks: Sequence[float]) -> DataFrame:
    """``column_name, quantiles`` of the number columns at the given ranks."""
    wanted = ", ".join(f"{r}D" for r in ranks)
    return found.filter("kll is not null and n > 0").select(
        "column_name", F.expr(f"kll_sketch_get_quantile_double(kll, array({wanted}))").alias("quantiles"))


def store_profile(store: TableStore, name: str, profile_date: dt.date, approximate: bool = False) -> int:
    """Profile a stored table and keep the rows; a profile of the same table and day is replaced. Returns the columns profiled."""
    found = profile(store.read(name), name, profile_date, approximate).withColumn("avg_value", rounded("avg_value")).select(
        *[clipped(F.col(c), 255).alias(c) if c in ("min_value", "max_value", "most_frequent_value") else F.col(c) for c in COLUMNS])
    if store.exists(PROFILE):
        others = store.read(PROFILE).filter(~((F.col("table_name") == name) & (F.col("profile_date") == F.lit(profile_date))))
        last = store.read(PROFILE).agg(F.coalesce(F.max("profile_id"), F.lit(0))).first()[0]
    else:
        others, last = None, 0
    # one row for each column of a table
    numbered = found.withColumn("profile_id", (F.row_number().over(Window.orderBy("column_name")) + F.lit(last)).cast("bigint")).select(
        "profile_id", *COLUMNS)
    count = numbered.count()
    store.replace((numbered if others is None else others.unionByName(numbered)).coalesce(1), PROFILE)
    return count
