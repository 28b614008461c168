"""Sales, customer, product, campaign and cohort reports.

Facts are aggregated on their own keys before a dimension is joined wherever the result
allows it, so the large table is shuffled in its reduced form and a hot key is combined on
the map side. Ties in top-k reports are broken by business key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import decimal_sum, full_years, mean, percent, ratio, rounded, row_count, tier
from tillstar.functions.bins import CLV_TIER_REST, CLV_TIERS, VALUE_TIER_REST, VALUE_TIERS
from tillstar.operators.aggregates import exact_mean, group_with_distincts, share_of_total
from tillstar.operators.pairs import name_pairs
from tillstar.plans.facts import YEAR, since

CHURN_DAYS = 180


def months_before(day: dt.date, months: int) -> dt.date:
    """The same day some months earlier, or that month's last day."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    following = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return dt.date(year, month + 1, min(day.day, (following - dt.timedelta(days=1)).day))


def with_dates(fact: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """Fact rows with attributes of their day. Loads extend the date dimension to all years with facts; it holds
    one row per day, so the range of dates bounds the broadcast."""
    days = dim_date.select(F.col("date_key").alias("transaction_date_key"), *columns)
    return fact.join(F.broadcast(days), "transaction_date_key")


def current(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.filter("is_current")


def sales_per_customer(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_key").agg(row_count().alias("lines"), F.sum("net_amount").alias("net"))


def last_purchase(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Day of the last sale per customer version."""
    last = fact.groupBy("customer_key").agg(F.max("transaction_date_key").alias("transaction_date_key"))
    return with_dates(last, dim_date, "date_actual").select("customer_key", "date_actual")


# --- customers ------------------------------------------------------------------------------


def top_customers(dim_customer: DataFrame, as_of: dt.date, k: int = 20) -> DataFrame:
    return (
        current(dim_customer)
        .filter("total_orders > 0")
        .orderBy(F.col("total_spent").desc_nulls_first(), "customer_id")
        .limit(k)
        .select(
            "customer_id", "full_name", "customer_segment", "city", "state", "total_orders",
            F.col("total_spent").alias("lifetime_value"),
            rounded(ratio("total_spent", "total_orders")).alias("avg_order_value"), "registration_date",
            full_years("registration_date", F.lit(as_of)).alias("customer_tenure_years"),
        )
    )


def value_tiers(dim_customer: DataFrame) -> DataFrame:
    return (
        current(dim_customer)
        .groupBy(tier("lifetime_value", VALUE_TIERS, VALUE_TIER_REST).alias("value_tier"))
        .agg(
            row_count().alias("customer_count"),
            rounded(mean("lifetime_value")).alias("avg_lifetime_value"),
            decimal_sum("lifetime_value").alias("total_revenue"),
            rounded(mean("total_orders"), 1).alias("avg_orders_per_customer"),
        )
        .orderBy(F.col("avg_lifetime_value").desc_nulls_first(), "value_tier")
    )


def churn_by_segment(dim_customer: DataFrame, fact: DataFrame, dim_date: DataFrame, as_of: dt.date) -> DataFrame:
    """Customers whose last purchase is more than 180 days back. Customers who never bought
    are in the total and not at risk."""
    days = F.date_diff(F.lit(as_of), "date_actual")
    return (
        current(dim_customer)
        .select("customer_key", "customer_segment")
        .join(last_purchase(fact, dim_date), "customer_key", "left")
        .groupBy("customer_segment")
        .agg(row_count().alias("total_customers"), F.count_if(days > CHURN_DAYS).alias("at_risk_customers"))
        .withColumn("churn_risk_percentage", percent("at_risk_customers", "total_customers"))
        .orderBy(F.col("churn_risk_percentage").desc_nulls_first(), "customer_segment")
    )


# --- sales ----------------------------------------------------------------------------------


def monthly_revenue(fact: DataFrame, dim_date: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    recent = since(fact, months_before(as_of, months))
    dated = with_dates(recent, dim_date, "year_number", "month_number", "month_name")
    return group_with_distincts(
        dated,
        ["year_number", "month_name", "month_number"],
        {
            "total_units_sold": F.sum("quantity"),
            "total_revenue": decimal_sum("net_amount"),
            "total_discounts": decimal_sum("discount_amount"),
            "avg_transaction_value": rounded(mean("net_amount")),
        },
        {"total_transactions": "transaction_id", "unique_customers": "customer_key"},
    ).orderBy("year_number", "month_number")


def weekday_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    grouped = (
        with_dates(fact, dim_date, "day_name", "day_of_week")
        .groupBy("day_name", "day_of_week")
        .agg(
            F.count_distinct("transaction_id").alias("total_transactions"),
            decimal_sum("net_amount").alias("total_revenue"),
            rounded(mean("net_amount")).alias("avg_transaction_value"),
        )
    )
    return share_of_total(grouped, "total_revenue", "revenue_percentage").orderBy("day_of_week")


def revenue_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Days are summed before they meet the calendar."""
    daily = fact.groupBy("transaction_date_key").agg(F.sum("net_amount").alias("net"))
    return (
        with_dates(daily, dim_date, "year_number", "month_number")
        .groupBy("year_number", "month_number")
        .agg(decimal_sum("net").alias("revenue"))
    )


def growth(now: str | Column, before: str | Column) -> Column:
    return percent(F.col(now) - F.col(before), before)


def year_over_year(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Months that have the same month a year earlier. The earlier month is matched by its
    key, since an offset of twelve rows is wrong as soon as a month is missing."""
    monthly = revenue_by_month(fact, dim_date)
    before = monthly.select(
        (F.col("year_number") + 1).alias("year_number"), "month_number",
        F.col("revenue").alias("previous_year_revenue"),
    )
    change = (F.col("revenue") - F.col("previous_year_revenue")).cast("decimal(28,2)")
    return (
        monthly.join(before, ["year_number", "month_number"])
        .filter(F.col("previous_year_revenue").isNotNull())
        .select(
            F.col("year_number").alias("current_year"), "month_number",
            F.col("revenue").alias("current_year_revenue"), "previous_year_revenue", change.alias("revenue_change"),
            growth("revenue", "previous_year_revenue").alias("yoy_growth_percentage"),
        )
        .orderBy("current_year", "month_number")
    )


# --- products -------------------------------------------------------------------------------


def between(fact: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Fact rows of a period, both days inside; bounds on year and date key prune what lies outside."""
    for day, late in ((first, False), (last, True)):
        if day is not None:
            number, key, year = day.year * 10000 + day.month * 100 + day.day, F.col("transaction_date_key"), F.col(YEAR)
            fact = fact.filter(key <= number if late else key >= number)
            if YEAR in fact.columns:
                fact = fact.filter(year <= day.year if late else year >= day.year)
    return fact


def top_products(
    fact: DataFrame, dim_product: DataFrame, k: int = 20, by: str = "total_revenue",
    first: dt.date | None = None, last: dt.date | None = None,
) -> DataFrame:
    """Best products of a period by revenue, or ``by`` units sold or purchases."""
    fact = between(fact, first, last)
    sold = fact.groupBy("product_key").agg(
        F.sum("quantity").alias("units_sold"),
        F.count_distinct("transaction_id").alias("times_purchased"),
        decimal_sum("net_amount").alias("total_revenue"),
        rounded(mean("unit_price")).alias("avg_selling_price"),
    )
    return (
        sold.join(dim_product, "product_key")
        .orderBy(F.col(by).desc_nulls_first(), "product_id")
        .limit(k)
        .select(
            "product_id", "product_name", "product_category", "product_subcategory", "brand", "units_sold",
            "times_purchased", "total_revenue", "avg_selling_price", F.col("retail_price").alias("list_price"),
            F.col("margin_percentage").alias("margin_pct"),
        )
    )


def category_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales are summed per product before the category is joined; customers are counted on
    distinct (category, customer) pairs."""
    product = dim_product.select("product_key", "product_category", "unit_cost")
    per_product = fact.groupBy("product_key").agg(
        F.sum("quantity").alias("units"),
        F.sum("net_amount").alias("net"),
        F.count("net_amount").alias("lines"),
        # profit counts only lines that have both an amount and a quantity
        F.sum(F.when(F.col("quantity").isNotNull(), F.col("net_amount"))).alias("costed_net"),
        F.sum(F.when(F.col("net_amount").isNotNull(), F.col("quantity"))).alias("costed_units"),
    )
    profit = F.when(
        F.col("unit_cost").isNotNull(), F.col("costed_net") - F.col("costed_units") * F.col("unit_cost")
    )
    sales = (
        per_product.join(product, "product_key")
        .groupBy("product_category")
        .agg(
            row_count().alias("product_count"),
            F.sum("units").alias("total_units_sold"),
            decimal_sum("net").alias("total_revenue"),
            rounded(ratio(F.sum("net"), F.sum("lines"))).alias("avg_transaction_value"),
            F.sum(profit).cast("decimal(28,2)").alias("total_profit"),
        )
    )
    buyers = (
        # distinct pairs of product and customer come first, so the fact itself is never joined
        fact.select("product_key", "customer_key").distinct()
        .join(product.select("product_key", F.col("product_category").alias("_category")), "product_key")
        .groupBy("_category")
        .agg(F.count_distinct("customer_key").alias("unique_customers"))
    )
    return (
        sales.join(buyers, F.col("product_category").eqNullSafe(F.col("_category")))
        .withColumn("profit_margin_pct", percent("total_profit", "total_revenue"))
        .select(
            "product_category", "product_count", "total_units_sold", "unique_customers", "total_revenue",
            "avg_transaction_value", "total_profit", "profit_margin_pct",
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), "product_category")
    )


def product_affinity(fact: DataFrame, dim_product: DataFrame, min_shared: int = 5, k: int = 20) -> DataFrame:
    """Pairs of product names sharing at least ``min_shared`` transactions. The value is the
    average over all line pairs."""
    return (
        name_pairs(fact, dim_product, min_shared)
        .orderBy(F.col("times_bought_together").desc(), "product_1", "product_2")
        .limit(k)
        .select(
            "product_1", "product_2", "times_bought_together",
            rounded(ratio("value", "line_pairs")).alias("avg_combined_value"),
        )
    )


# --- campaigns ------------------------------------------------------------------------------


def _response_counts() -> list[Column]:
    return [
        F.count_distinct("customer_key").alias("reached"),
        F.count_if("is_opened").alias("opened"),
        F.count_if("is_clicked").alias("clicked"),
        F.count_if("is_converted").alias("converted"),
        decimal_sum("conversion_value").alias("value"),
    ]


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def campaign_results(dim_campaign: DataFrame, responses: DataFrame) -> DataFrame:
    """Every campaign with its response counts; campaigns without responses have no value."""
    counted = responses.groupBy("campaign_key").agg(*_response_counts())
    return dim_campaign.join(counted, "campaign_key", "left").select(
        *dim_campaign.columns, *[_or_zero(n) for n in ("reached", "opened", "clicked", "converted")], "value"
    )


def campaign_roi(dim_campaign: DataFrame, responses: DataFrame) -> DataFrame:
    done = campaign_results(dim_campaign.filter("campaign_status = 'Completed'"), responses)
    gain = (F.col("value") - F.col("budget")).cast("decimal(28,2)")
    return done.select(
        "campaign_id", "campaign_name", "campaign_type", "channel",
        F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
        F.date_format("end_date", "yyyy-MM-dd").alias("end_date"), "duration_days", "budget",
        F.col("reached").alias("total_responses"), F.col("converted").alias("conversions"),
        percent("converted", "reached").alias("conversion_rate"), F.col("value").alias("total_conversion_value"),
        gain.alias("roi_amount"), percent(gain, "budget").alias("roi_percentage"),
    ).orderBy(F.col("roi_percentage").desc_nulls_first(), "campaign_id")


def campaign_funnel(dim_campaign: DataFrame, responses: DataFrame) -> DataFrame:
    """Funnel per campaign name and channel. A response carries one type only, so a later
    step may exceed an earlier one and rates may exceed 100."""
    done = dim_campaign.filter("campaign_status = 'Completed'").select("campaign_key", "campaign_name", "channel")
    counted = responses.join(done, "campaign_key").groupBy("campaign_name", "channel").agg(*_response_counts())
    named = counted.select(
        F.col("campaign_name").alias("_name"), F.col("channel").alias("_channel"), "reached", "opened", "clicked",
        "converted",
    )
    same = F.col("campaign_name").eqNullSafe(F.col("_name")) & F.col("channel").eqNullSafe(F.col("_channel"))
    return (
        done.select("campaign_name", "channel").distinct()
        .join(named, same, "left")
        .select("campaign_name", "channel", *[_or_zero(n) for n in ("reached", "opened", "clicked", "converted")])
        .select(
            "campaign_name", "channel", F.col("reached").alias("total_reached"), "opened", "clicked", "converted",
            percent("opened", "reached").alias("open_rate"), percent("clicked", "opened").alias("click_through_rate"),
            percent("converted", "clicked").alias("conversion_rate"),
        )
        .orderBy(F.col("total_reached").desc(), "campaign_name", "channel")
    )


# --- cohorts, value segments, geography -----------------------------------------------------


def _weighted_mean(value: str, weight: Column) -> Column:
    known = F.col(value).isNotNull()
    return ratio(F.sum(F.col(value) * weight), F.sum(F.when(known, weight)))


def cohorts(dim_customer: DataFrame, fact: DataFrame) -> DataFrame:
    """Revenue by registration month. Customer averages weigh each customer by their sales
    lines (one if none), as a join to the lines would; the lines themselves are not joined."""
    weight = F.coalesce(F.col("lines"), F.lit(1))
    return (
        current(dim_customer)
        .join(sales_per_customer(fact), "customer_key", "left")
        .groupBy(F.date_format("registration_date", "yyyy-MM").alias("cohort_month"))
        .agg(
            row_count().alias("cohort_size"),
            decimal_sum("net").alias("total_revenue"),
            rounded(_weighted_mean("total_spent", weight)).alias("avg_customer_value"),
            rounded(_weighted_mean("total_orders", weight), 1).alias("avg_orders_per_customer"),
        )
        .orderBy(F.col("cohort_month").desc_nulls_first())
    )


def clv_segments(dim_customer: DataFrame, as_of: dt.date) -> DataFrame:
    tenure = F.date_diff(F.lit(as_of), "registration_date")
    return (
        current(dim_customer)
        .filter("total_orders > 0")
        .groupBy(tier("total_spent", CLV_TIERS, CLV_TIER_REST).alias("clv_segment"))
        .agg(
            row_count().alias("customer_count"),
            rounded(mean("total_spent")).alias("avg_lifetime_value"),
            rounded(mean("total_orders"), 1).alias("avg_orders"),
            rounded(exact_mean(ratio("total_spent", "total_orders"))).alias("avg_order_value"),
            rounded(exact_mean(ratio(tenure, "total_orders")), 1).alias("avg_days_between_orders"),
        )
        .orderBy(F.col("avg_lifetime_value").desc_nulls_first(), "clv_segment")
    )


def state_revenue(dim_customer: DataFrame, fact: DataFrame, k: int = 20) -> DataFrame:
    """Revenue per state; the share is taken over all states before the cut to ``k``."""
    grouped = (
        current(dim_customer)
        .join(sales_per_customer(fact), "customer_key")
        .groupBy("state")
        .agg(
            row_count().alias("customer_count"),
            decimal_sum("net").alias("total_revenue"),
            rounded(_weighted_mean("total_spent", F.col("lines"))).alias("avg_customer_value"),
        )
    )
    shared = share_of_total(grouped, "total_revenue", "revenue_percentage")
    return shared.orderBy(F.col("total_revenue").desc_nulls_first(), "state").limit(k)


def dimension_completeness(dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Missing contact data of customers, then missing attributes of products, under the
    column names of the customer part."""

    def part(df: DataFrame, label: str, first: str, second: str) -> DataFrame:
        return df.agg(
            F.lit(label).alias("dimension"), row_count().alias("total_records"),
            F.count_if(F.col(first).isNull()).alias("missing_email"),
            F.count_if(F.col(second).isNull()).alias("missing_phone"),
        ).withColumn("email_null_pct", percent("missing_email", "total_records"))

    return part(current(dim_customer), "Customer", "email", "phone_number").union(
        part(dim_product, "Product", "product_category", "brand")
    )
