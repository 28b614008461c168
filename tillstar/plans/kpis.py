"""Key figures.

Adjustments that need data the warehouse does not hold are not applied: test accounts,
refunds, returns, cancellations, one-time events, seasonality and business-day effects.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import decimal_sum, percent, ratio, row_count, score_band
from tillstar.operators.aggregates import share_of_total
from tillstar.operators.keys import stored_once
from tillstar.plans import analytics
from tillstar.plans.facts import since
from tillstar.plans.validation import REFERENCES, integrity_report

OUTLIER = 10000  # transactions above this amount do not count towards the order value
ATTRIBUTION_DAYS = 30


def _ids(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select("customer_key", "customer_id")


# --- customers ------------------------------------------------------------------------------


def active_customers(fact: DataFrame, dim_customer: DataFrame, as_of: dt.date) -> DataFrame:
    """Customers with a sale in the last 12 months, over all their versions."""
    recent = since(fact, analytics.months_before(as_of, 12)).select("customer_key").distinct()
    return recent.join(_ids(dim_customer), "customer_key").agg(
        F.count_distinct("customer_id").alias("active_customers")
    )


def lifetime_value(dim_customer: DataFrame) -> DataFrame:
    """Average spend of current versions with orders, overall and per segment."""
    buyers = analytics.current(dim_customer).filter("total_orders > 0")
    # the overall row is derived from the segment rows, so the dimension is scanned once
    segments = buyers.groupBy("customer_segment").agg(
        row_count().alias("customers"), decimal_sum("total_spent").alias("spent")
    )
    overall = segments.agg(
        F.lit("ALL").alias("segment"), F.sum("customers").alias("customers"), decimal_sum("spent").alias("spent")
    )
    return overall.union(segments.select("customer_segment", "customers", "spent")).select(
        "segment", "customers", ratio("spent", "customers").alias("average_lifetime_value")
    )


def lifetime_value_per_customer(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Average spend per business customer, summed over all versions."""
    spent = (
        fact.groupBy("customer_key").agg(F.sum("net_amount").alias("net"))
        .join(_ids(dim_customer), "customer_key")
        .groupBy("customer_id").agg(F.sum("net").alias("net"))
    )
    return spent.agg(row_count().alias("customers"), ratio(F.sum("net"), row_count()).alias("average_lifetime_value"))


def registrations(dim_customer: DataFrame) -> DataFrame:
    """New customers per month, by the first registration of each customer."""
    first = dim_customer.groupBy("customer_id").agg(F.min("registration_date").alias("first"))
    return (
        first.filter(F.col("first").isNotNull())
        .groupBy(F.date_format("first", "yyyy-MM").alias("month")).agg(row_count().alias("new_customers"))
    )


def churn_rate(dim_customer: DataFrame, fact: DataFrame, dim_date: DataFrame, as_of: dt.date) -> DataFrame:
    """Customers whose last purchase is over 180 days back, of all customers."""
    bought = (
        analytics.last_purchase(fact, dim_date).join(_ids(dim_customer), "customer_key")
        .groupBy("customer_id").agg(F.max("date_actual").alias("last"))
    )
    late = F.date_diff(F.lit(as_of), "last") > analytics.CHURN_DAYS
    customers = analytics.current(dim_customer).select("customer_id")
    return (
        customers.join(bought, "customer_id", "left")
        .agg(row_count().alias("customers"), F.count_if(late).alias("churned"))
        .withColumn("churn_rate", percent("churned", "customers", None))
    )


def repeat_rate(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customers with at least two orders, of those with at least one."""
    pairs = fact.select("customer_key", "transaction_id").distinct()
    orders = (
        pairs.groupBy("customer_key").agg(row_count().alias("orders"))
        .join(_ids(dim_customer), "customer_key").groupBy("customer_id").agg(F.sum("orders").alias("orders"))
    )
    return orders.agg(
        row_count().alias("buyers"), F.count_if(F.col("orders") >= 2).alias("repeat_buyers")
    ).withColumn("repeat_rate", percent("repeat_buyers", "buyers", None))


# --- revenue --------------------------------------------------------------------------------


def revenue_per_period(fact: DataFrame, dim_date: DataFrame, period: str = "month") -> DataFrame:
    """Revenue per week, month, quarter or year."""
    daily = fact.groupBy("transaction_date_key").agg(F.sum("net_amount").alias("net"))
    return (
        analytics.with_dates(daily, dim_date, "date_actual")
        .groupBy(F.trunc("date_actual", period).alias("period_start"))
        .agg(decimal_sum("net").alias("total_revenue"))
    )


def average_order_value(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per transaction by month, leaving out transactions over the outlier bound.
    Transactions are summed first, then averaged."""
    orders = fact.groupBy("transaction_id", "transaction_date_key").agg(F.sum("net_amount").alias("net"))
    kept = orders.filter(F.col("net") <= OUTLIER)
    return (
        analytics.with_dates(kept, dim_date, "year_number", "month_number")
        .groupBy("year_number", "month_number")
        .agg(F.count_distinct("transaction_id").alias("transactions"), decimal_sum("net").alias("revenue"))
        .withColumn("average_order_value", ratio("revenue", "transactions"))
    )


def month_over_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Growth against the calendar month before; months without sales count as zero.

    The spine has one row per month between the first and the last sale, a few hundred at
    most, so the ordered window over it is small.
    """
    # read twice, for the bounds and for the values: a few hundred stored rows
    monthly = stored_once(revenue_per_period(fact, dim_date, "month"), "monthly")
    bounds = monthly.agg(F.min("period_start").alias("first"), F.max("period_start").alias("last"))
    spine = bounds.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("period_start")
    )
    zero = F.lit(0).cast("decimal(28,2)")
    complete = spine.join(monthly, "period_start", "left").select(
        F.col("period_start").alias("month_start"), F.coalesce("total_revenue", zero).alias("revenue")
    )
    before = F.lag("revenue").over(Window.orderBy("month_start"))
    return complete.withColumn("previous_revenue", before).withColumn(
        "growth_percentage", percent(F.col("revenue") - F.col("previous_revenue"), "previous_revenue", None)
    )


def year_over_year(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return analytics.year_over_year(fact, dim_date).select(
        F.col("current_year").alias("year_number"), "month_number",
        F.col("yoy_growth_percentage").alias("growth_percentage"),
    )


def revenue_by_segment(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Revenue by the segment a customer has now, over the sales of all their versions."""
    now = analytics.current(dim_customer).select("customer_id", "customer_segment")
    grouped = (
        fact.groupBy("customer_key").agg(F.sum("net_amount").alias("net"))
        .join(_ids(dim_customer), "customer_key")
        .join(now, "customer_id")
        .groupBy("customer_segment").agg(decimal_sum("net").alias("revenue"))
    )
    return share_of_total(grouped, "revenue", "revenue_share")


# --- products -------------------------------------------------------------------------------


def units_per_period(fact: DataFrame, dim_date: DataFrame, period: str = "month") -> DataFrame:
    daily = fact.groupBy("transaction_date_key").agg(F.sum("quantity").alias("units"))
    return (
        analytics.with_dates(daily, dim_date, "date_actual")
        .groupBy(F.trunc("date_actual", period).alias("period_start")).agg(F.sum("units").alias("units_sold"))
    )


def top_products(
    fact: DataFrame, dim_product: DataFrame, k: int = 10, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Best products of a period with their share of the revenue of all products."""
    sold = analytics.between(fact, first, last).groupBy("product_key").agg(decimal_sum("net_amount").alias("revenue")).join(
        dim_product.select("product_key", "product_id", "product_name"), "product_key"
    ).select("product_id", "product_name", "revenue")
    shared = share_of_total(sold, "revenue", "revenue_share")
    return shared.orderBy(F.col("revenue").desc_nulls_first(), "product_id").limit(k)


def category_performance(
    fact: DataFrame, dim_product: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    return analytics.category_performance(analytics.between(fact, first, last), dim_product).select(
        "product_category", "total_revenue", "total_units_sold", "profit_margin_pct"
    )


def weighted_margin(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Average margin weighted by units sold."""
    sold = fact.groupBy("product_key").agg(F.sum("quantity").alias("units")).join(
        dim_product.select("product_key", "margin_percentage"), "product_key"
    ).filter(F.col("margin_percentage").isNotNull())
    return sold.agg(
        F.sum("units").alias("units"),
        ratio(F.sum(F.col("margin_percentage") * F.col("units")), F.sum("units")).alias("average_margin"),
    )


# --- campaigns ------------------------------------------------------------------------------


def campaign_roi(dim_campaign: DataFrame, responses: DataFrame) -> DataFrame:
    """Return on the budget of completed campaigns, from converted responses."""
    done = analytics.campaign_results(
        dim_campaign.filter("campaign_status = 'Completed'"), responses.filter("is_converted")
    )
    value = F.coalesce("value", F.lit(0).cast("decimal(28,2)"))
    return done.select(
        "campaign_id", "channel", "budget", value.alias("revenue"), percent(value - F.col("budget"), "budget", None).alias("roi")
    )


def channel_conversion(dim_campaign: DataFrame, responses: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Converted customers of the customers reached, per channel.

    A customer belongs to the campaign of their first response (ties by campaign key), and a
    conversion counts for that campaign within 30 days of its start.
    """
    dated = responses.join(
        F.broadcast(dim_date.select(F.col("date_key").alias("response_date_key"), "date_actual")), "response_date_key"
    ).select("customer_key", "campaign_key", "date_actual", "is_converted")
    first = dated.groupBy("customer_key").agg(
        F.min_by("campaign_key", F.struct("date_actual", "campaign_key")).alias("campaign_key")
    )
    campaigns = dim_campaign.select("campaign_key", "channel", "start_date")
    age = F.date_diff("date_actual", "start_date")
    # per customer and campaign one row, before the first touch is joined
    won = (
        dated.filter("is_converted").join(campaigns, "campaign_key")
        .filter((age >= 0) & (age <= ATTRIBUTION_DAYS))
        .select("customer_key", "campaign_key").distinct().withColumn("won", F.lit(True))
    )
    return (
        first.join(won, ["customer_key", "campaign_key"], "left")
        .join(campaigns.select("campaign_key", "channel"), "campaign_key")
        .groupBy("channel")
        .agg(row_count().alias("reached"), F.count("won").alias("converted"))
        .withColumn("conversion_rate", percent("converted", "reached", None))
    )


def cost_per_acquisition(dim_campaign: DataFrame, responses: DataFrame) -> DataFrame:
    return analytics.campaign_results(dim_campaign, responses).select(
        "campaign_id", "budget", F.col("converted").alias("conversions"), ratio("budget", "converted").alias("cost_per_acquisition")
    )


def _email(dim_campaign: DataFrame, responses: DataFrame) -> DataFrame:
    return analytics.campaign_results(dim_campaign.filter("channel = 'Email'"), responses)


def email_open_rate(dim_campaign: DataFrame, responses: DataFrame) -> DataFrame:
    return _email(dim_campaign, responses).select(
        "campaign_id", "reached", "opened", percent("opened", "reached", None).alias("open_rate")
    )


def email_click_through(dim_campaign: DataFrame, responses: DataFrame) -> DataFrame:
    return _email(dim_campaign, responses).select(
        "campaign_id", "opened", "clicked", percent("clicked", "opened", None).alias("click_through_rate")
    )


# --- operations and quality -----------------------------------------------------------------


def load_success_rate(audit_log: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("load_status") == "SUCCESS")
    return audit_log.agg(row_count().alias("loads"), ok.alias("succeeded")).withColumn(
        "success_rate", percent("succeeded", "loads", None)
    )


def freshness(staged: DataFrame, source_time: str) -> DataFrame:
    """Hours between the newest source record and its load, whole hours rounded down."""
    gap = F.timestamp_diff("HOUR", F.max(F.col(source_time).cast("timestamp_ntz")), F.max("load_timestamp"))
    return staged.agg(row_count().alias("records"), gap.cast("bigint").alias("lag_hours"))


def on_time_rate(staged: DataFrame, source_time: str, sla_hours: int) -> DataFrame:
    """Records loaded within the agreed number of hours of their source time."""
    lag = F.timestamp_diff("SECOND", F.col(source_time).cast("timestamp_ntz"), F.col("load_timestamp"))
    return staged.filter(F.col(source_time).isNotNull()).agg(
        row_count().alias("records"), F.count_if(lag <= sla_hours * 3600).alias("on_time")
    ).withColumn("on_time_rate", percent("on_time", "records", None))


def overall_quality(scorecards: DataFrame) -> DataFrame:
    return scorecards.select(
        "report_date", "overall_quality_score", score_band("overall_quality_score").alias("score_band")
    )


def completeness(df: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    """Filled share of each required field with its band, from one scan."""
    counted = df.agg(row_count().alias("_rows"), *[F.count(c).alias(f"_{c}") for c in required])
    cells = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col("_rows").alias("records"),
            F.col(f"_{c}").alias("filled"), percent(f"_{c}", "_rows", None).alias("completeness"),
        )
        for c in required
    ]
    share = F.col("completeness")
    band = F.when(share > 95, "OK").when(share >= 80, "WARNING").otherwise("FAILURE")
    return counted.select(F.inline(F.array(*cells))).withColumn("band", band)


def accuracy(results: DataFrame, rules: DataFrame, cats: DataFrame, as_of: dt.date) -> DataFrame:
    """Share of checked records that pass the accuracy and validity rules of a day."""
    wanted = cats.filter(F.col("category_name").isin("Accuracy", "Validity")).select("category_id")
    known = rules.join(F.broadcast(wanted), "category_id").select("rule_id")
    day = results.filter(F.to_date("execution_date") == F.lit(as_of)).join(F.broadcast(known), "rule_id")
    return day.agg(
        F.sum("total_records_checked").alias("checked"), F.sum("passed_records").alias("passed")
    ).withColumn("accuracy", percent("passed", "checked", None))


def referential_integrity(tables: Mapping[str, DataFrame], references=REFERENCES) -> DataFrame:
    """Share of references that point to an existing dimension row, per reference."""
    report = integrity_report(tables, references).drop("dim_table")
    valid = F.col("records") - F.col("orphan_count")
    return report.withColumn("integrity", percent(valid, "records", None))


def duplicate_rate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records beyond the first of each natural key, of all records. Copies of a key are
    combined before the shuffle."""
    groups = df.groupBy(*keys).agg(row_count().alias("copies"))
    return groups.agg(
        F.sum("copies").alias("records"), F.sum(F.col("copies") - 1).alias("duplicates")
    ).withColumn("duplicate_rate", percent("duplicates", "records", None))
