"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.catalog.base import SALES_AS_OF, Context, query, sql_percent, sql_ratio, sql_round
from tillstar.functions import (
    age_group, binned, clipped, date_key, full_years, padded_id, percent, quarter_end, ratio, rounded, whole_year_age,
)

DAY = f"date '{SALES_AS_OF}'"


@query("X01_concat_null_propagation", """
    select customer_id, first_name || ' ' || last_name as full_name, customer_id || phone_number as id_phone
    from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_crm_customers").select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.concat("customer_id", "phone_number").alias("id_phone"),
    )


@query("X02_cast_to_text", """
    select transaction_key, cast(net_amount as varchar) as net_text, cast(quantity as varchar) as quantity_text,
           cast(transaction_date_key as varchar) as day_text
    from fact_transactions""")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].select(
        "transaction_key", F.col("net_amount").cast("string").alias("net_text"),
        F.col("quantity").cast("string").alias("quantity_text"),
        F.col("transaction_date_key").cast("string").alias("day_text"),
    )


@query("X03_truncate_text", """
    select customer_id, substring(email, 1, 8) as clipped_email, substring(full_name, 1, 50) as clipped_name
    from customers_merged""")
def _(c: Context) -> DataFrame:
    return c["dim_customer"].select(
        "customer_id", clipped("email", 8).alias("clipped_email"), clipped("full_name", 50).alias("clipped_name")
    )


@query("X04_md5", "select product_id, md5(product_id || '_' || brand) as digest from stg_products")
def _(c: Context) -> DataFrame:
    return c.stg("stg_products").select("product_id", F.md5(F.concat("product_id", F.lit("_"), "brand")).alias("digest"))


@query("X05_lower_suffix", "select distinct lower(product_category) || '_score' as score_name from stg_products")
def _(c: Context) -> DataFrame:
    return c.stg("stg_products").select(
        F.concat(F.lower("product_category"), F.lit("_score")).alias("score_name")
    ).distinct()


@query("X06_padded_ids", """
    select o_orderkey, 'TXN' || lpad(cast(o_orderkey as varchar), cast(greatest(8, length(cast(o_orderkey as varchar))) as int), '0') as transaction_id,
           'C' || lpad(cast(o_custkey as varchar), cast(greatest(2, length(cast(o_custkey as varchar))) as int), '0') as short_id
    from orders""")
def _(c: Context) -> DataFrame:
    orders = c.spark.read.parquet(f"{c.folder}/orders.parquet")
    return orders.select(
        "o_orderkey", padded_id("TXN", "o_orderkey").alias("transaction_id"), padded_id("C", "o_custkey", 2).alias("short_id")
    )


@query("X07_date_formats", """
    select transaction_id, strftime(transaction_date, '%Y%m%d') as ymd, strftime(transaction_date, '%Y-%m') as ym,
           strftime(transaction_date, '%Y-%m-%d') as iso, strftime(transaction_date, '%A') as day_name,
           strftime(transaction_date, '%B') as month_name, strftime(transaction_date, '%b') as month_abbr,
           cast(strftime(transaction_date, '%Y%m%d') as int) as date_key
    from stg_ecom_transactions""")
def _(c: Context) -> DataFrame:
    def fmt(pattern: str):
        return F.date_format("transaction_date", pattern)

    return c.stg("stg_ecom_transactions").select(
        "transaction_id", fmt("yyyyMMdd").alias("ymd"), fmt("yyyy-MM").alias("ym"), fmt("yyyy-MM-dd").alias("iso"),
        fmt("EEEE").alias("day_name"), fmt("MMMM").alias("month_name"), fmt("MMM").alias("month_abbr"),
        date_key("transaction_date").alias("date_key"),
    )


@query("X08_date_parts", """
    select customer_id, cast(year(date_of_birth) as int) as y, cast(month(date_of_birth) as int) as m,
           cast(day(date_of_birth) as int) as d, cast(quarter(date_of_birth) as int) as q,
           cast(dayofyear(date_of_birth) as int) as doy, cast(weekofyear(date_of_birth) as int) as iso_week
    from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    b = F.col("date_of_birth")
    return c.stg("stg_crm_customers").select(
        "customer_id", F.year(b).alias("y"), F.month(b).alias("m"), F.dayofmonth(b).alias("d"), F.quarter(b).alias("q"),
        F.dayofyear(b).alias("doy"), F.weekofyear(b).alias("iso_week"),
    )


@query("X09_day_of_week", """
    select transaction_id, cast(dayofweek(transaction_date) as int) as day_of_week from stg_ecom_transactions""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_ecom_transactions").select(
        "transaction_id", (F.dayofweek("transaction_date") - 1).alias("day_of_week")
    )


@query("X10_period_starts", """
    select transaction_id, cast(date_trunc('week', transaction_date) as date) as week_start,
           cast(date_trunc('month', transaction_date) as date) as month_start,
           cast(date_trunc('quarter', transaction_date) as date) as quarter_start
    from stg_ecom_transactions""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_ecom_transactions").select(
        "transaction_id",
        *[F.trunc("transaction_date", p).alias(f"{p}_start") for p in ("week", "month", "quarter")],
    )


@query("X11_period_ends", """
    select transaction_id, last_day(transaction_date) as month_end,
           cast(date_trunc('quarter', transaction_date) + interval 3 month - interval 1 day as date) as quarter_end
    from stg_ecom_transactions""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_ecom_transactions").select(
        "transaction_id", F.last_day("transaction_date").alias("month_end"),
        quarter_end("transaction_date").alias("quarter_end"),
    )


@query("X12_day_difference", f"""
    select customer_id, cast(datediff('day', registration_date, {DAY}) as int) as tenure_days,
           cast(datediff('day', date_of_birth, registration_date) as int) as days_before
    from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_crm_customers").select(
        "customer_id", F.date_diff(F.lit(SALES_AS_OF), "registration_date").alias("tenure_days"),
        F.date_diff("registration_date", "date_of_birth").alias("days_before"),
    )


@query("X13_full_years", f"""
    select customer_id, cast(date_part('year', age({DAY}, registration_date)) as int) as tenure_years
    from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_crm_customers").select(
        "customer_id", full_years("registration_date", F.lit(SALES_AS_OF)).alias("tenure_years")
    )


@query("X14_age", f"""
    select customer_id, cast(floor(datediff('day', date_of_birth, {DAY}) / 365e0) as int) as age from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_crm_customers").select(
        "customer_id", whole_year_age("date_of_birth", F.lit(SALES_AS_OF)).alias("age")
    )


@query("X15_date_arithmetic", """
    select o_orderkey, cast(o_orderdate as date) as day, cast(cast(o_orderdate as date) - interval 12 month as date) as year_before,
           cast(o_orderdate as date) - 7 as week_before
    from orders""")
def _(c: Context) -> DataFrame:
    day = F.to_date("o_orderdate")
    return c.spark.read.parquet(f"{c.folder}/orders.parquet").select(
        "o_orderkey", day.alias("day"), F.add_months(day, -12).alias("year_before"), F.date_sub(day, 7).alias("week_before")
    )


@query("X16_day_series", """
    select campaign_id, cast(unnest(generate_series(cast(start_date as timestamp), cast(end_date as timestamp), interval 1 day)) as date) as day
    from stg_marketing_campaigns""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_marketing_campaigns").select(
        "campaign_id", F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias("day")
    )


@query("X17_round_abs", f"""
    select event_id, {sql_round('value')} as rounded, abs(value - 50e0) as distance, {sql_round('(value - 50e0) / 7e0', 1)} as one_digit
    from events""")
def _(c: Context) -> DataFrame:
    value = F.col("value")
    return c.spark.read.parquet(f"{c.folder}/events.parquet").select(
        "event_id", rounded(value).alias("rounded"), F.abs(value - 50.0).alias("distance"),
        rounded((value - 50.0) / 7.0, 1).alias("one_digit"),
    )


@query("X18_guarded_division", f"""
    select customer_key, {sql_ratio('total_spent', 'total_orders')} as order_value,
           {sql_percent('total_orders', 'total_spent')} as orders_per_hundred
    from dim_customer""")
def _(c: Context) -> DataFrame:
    return c["dim_customer"].select(
        "customer_key", ratio("total_spent", "total_orders").alias("order_value"),
        percent("total_orders", "total_spent").alias("orders_per_hundred"),
    )


@query("X19_coalesce", """
    select customer_id, coalesce(phone_number, email, 'none') as contact from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_crm_customers").select(
        "customer_id", F.coalesce("phone_number", "email", F.lit("none")).alias("contact")
    )


@query("X20_case", """
    select response_id, case when response_type = 'opened' then 1 when response_type = 'clicked' then 2 else 3 end as step
    from stg_campaign_responses""")
def _(c: Context) -> DataFrame:
    kind = F.col("response_type")
    return c.stg("stg_campaign_responses").select(
        "response_id", F.when(kind == "opened", 1).when(kind == "clicked", 2).otherwise(3).alias("step")
    )


@query("X21_right_closed_bins", f"""
    select customer_id,
           case when a > 0 and a <= 25 then '18-25' when a > 25 and a <= 35 then '26-35' when a > 35 and a <= 45 then '36-45'
                when a > 45 and a <= 55 then '46-55' when a > 55 and a <= 65 then '56-65' when a > 65 and a <= 100 then '65+'
                else 'nan' end as age_group,
           case when a > 20 and a <= 40 then 'young' when a > 40 and a <= 60 then 'old' else 'other' end as coarse
    from (select customer_id, cast(floor(datediff('day', date_of_birth, {DAY}) / 365e0) as int) as a from stg_crm_customers) q""")
def _(c: Context) -> DataFrame:
    aged = c.stg("stg_crm_customers").withColumn("age", whole_year_age("date_of_birth", F.lit(SALES_AS_OF)))
    return aged.select(
        "customer_id", age_group("age").alias("age_group"),
        binned("age", (20, 40, 60), ("young", "old"), "other").alias("coarse"),
    )
