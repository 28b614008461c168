"""Dimension builds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import age_group, date_key, percent, quarter_end, whole_year_age
from tillstar.operators.keys import with_keys
from tillstar.operators.rows import latest_load
from tillstar.operators.scd import Scd2Result, append_new, scd1_upsert, scd2_merge

# Which customer attributes open a new version and which change in place.
TRACKED = ("address", "city", "state", "postal_code", "customer_segment")
IN_PLACE = ("email", "phone_number")


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schemas.WAREHOUSE[table])


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.WAREHOUSE[table]])


# --- product -------------------------------------------------------------------------------


def derive_product(staged: DataFrame) -> DataFrame:
    """Latest staged row per product with margin and activity flag; rows without id dropped."""
    margin = percent(F.col("retail_price") - F.col("unit_cost"), "retail_price")
    return (
        latest_load(staged, "product_id")
        .select(
            "product_id", "product_name", "product_category", "product_subcategory", "brand", "unit_cost",
            "retail_price", margin.cast("decimal(9,2)").alias("margin_percentage"), "product_status",
            F.coalesce(F.col("product_status") == "Active", F.lit(False)).alias("is_active"),
            F.lit("E-COMMERCE").alias("source_system"),
        )
    )


def build_product(staged: DataFrame) -> DataFrame:
    """First load of the product dimension."""
    return _conform(with_keys(derive_product(staged), "product_key", ["product_id"]), "dim_product")


def upsert_product(dim: DataFrame, staged: DataFrame) -> DataFrame:
    """Type 1 load: known products are overwritten, unknown ones added, the rest kept."""
    source = derive_product(staged)
    overwrite = [c for c in source.columns if c not in ("product_id", "source_system")]
    return scd1_upsert(dim, source, "product_id", "product_key", overwrite)


# --- campaign ------------------------------------------------------------------------------


def derive_campaign(staged: DataFrame) -> DataFrame:
    return (
        latest_load(staged, "campaign_id")
        .select(
            "campaign_id", "campaign_name", "campaign_type", "channel", "start_date", "end_date",
            F.date_diff("end_date", "start_date").alias("duration_days"), "budget", "target_audience",
            "campaign_status", F.lit("MARKETING").alias("source_system"),
        )
    )


def build_campaign(staged: DataFrame) -> DataFrame:
    return _conform(with_keys(derive_campaign(staged), "campaign_key", ["campaign_id"]), "dim_campaign")


def load_campaign(dim: DataFrame, staged: DataFrame, update: bool = False) -> DataFrame:
    """Add unknown campaigns. Known ones stay as they are unless ``update`` is set."""
    source = derive_campaign(staged)
    if update:
        overwrite = [c for c in source.columns if c not in ("campaign_id", "source_system")]
        return scd1_upsert(dim, source, "campaign_id", "campaign_key", overwrite)
    return dim.unionByName(append_new(dim, source, "campaign_id", "campaign_key"))


# --- customer ------------------------------------------------------------------------------


def derive_customer(staged: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest staged row per customer with full name, age and age group.

    A missing name part leaves the full name missing. Age counts blocks of 365 days.
    """
    latest = latest_load(staged, "customer_id")
    return (
        latest.select(*schemas.SOURCE["stg_crm_customers"].names)
        .withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name"))
        .withColumn("age", whole_year_age("date_of_birth", F.lit(as_of)))
        .withColumn("age_group", age_group("age"))
        .withColumn("source_system", F.lit("CRM"))
    )


def merge_customer(dim: DataFrame, staged: DataFrame, as_of: dt.date) -> Scd2Result:
    """Merge a customer snapshot into the versioned dimension.

    Names, birth date, status and the derived age are taken when a version is opened; an
    unchanged or in-place-changed customer keeps the stored ones.
    """
    return scd2_merge(
        dim, derive_customer(staged, as_of), as_of, business_key="customer_id", surrogate="customer_key",
        tracked=TRACKED, in_place=IN_PLACE, first_valid_from="registration_date",
    )


def with_lifetime_metrics(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Set order count and spend of current versions that have sales.

    Metrics belong to a version: sales of an earlier version are not carried over. Versions
    without sales keep what they had.
    """
    sold = fact.groupBy("customer_key").agg(
        F.count_distinct("transaction_id").alias("orders"), F.sum("net_amount").cast("decimal(28,2)").alias("spent")
    )
    return with_sales(dim, sold)


def with_sales(dim: DataFrame, sold: DataFrame) -> DataFrame:
    """Set order count and spend of current versions from ``sold`` (customer_key, orders, spent); others keep what they had."""
    sold = sold.select("customer_key", F.col("orders").alias("_orders"), F.col("spent").alias("_spent"))
    joined = dim.join(sold, "customer_key", "left")
    hit = F.col("is_current") & F.col("_orders").isNotNull()
    spent = F.coalesce("_spent", F.lit(0).cast("decimal(28,2)"))
    return joined.withColumns(
        {
            "lifetime_value": F.when(hit, spent).otherwise(F.col("lifetime_value")),
            "total_orders": F.when(hit, F.col("_orders")).otherwise(F.col("total_orders")),
            "total_spent": F.when(hit, spent).otherwise(F.col("total_spent")),
        }
    ).select(*dim.columns)


# --- date ----------------------------------------------------------------------------------


def build_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day of a closed range. Weeks start on Monday; Sunday is day 0 of the week."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d"))
    d = F.col("d")
    dow = F.dayofweek(d) - 1
    weekend = dow.isin(0, 6)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("date_actual"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.trunc(d, "week").alias("week_start_date"),
        F.date_add(F.trunc(d, "week"), 6).alias("week_end_date"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbr"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.trunc(d, "quarter").alias("quarter_start_date"),
        quarter_end(d).alias("quarter_end_date"),
        F.year(d).alias("year_number"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        F.month(d).alias("fiscal_month"),
        weekend.alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
        (~weekend).alias("is_business_day"),
    )
