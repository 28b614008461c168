"""The analytical reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tillstar.catalog.base import (
    SALES_AS_OF, Context, define, query, sql_money, sql_percent, sql_ratio, sql_round,
)
from tillstar.plans import analytics

DAY = f"date '{SALES_AS_OF}'"


@query("Q01_top_customers", f"""
    select customer_id, full_name, customer_segment, city, state, total_orders, total_spent as lifetime_value,
           {sql_round(sql_ratio('total_spent', 'total_orders'))} as avg_order_value, registration_date,
           cast(date_part('year', age({DAY}, registration_date)) as int) as customer_tenure_years
    from dim_customer where is_current and total_orders > 0
    order by total_spent desc, customer_id limit 20""")
def _(c: Context) -> DataFrame:
    return analytics.top_customers(c["dim_customer"], SALES_AS_OF)


@query("Q02_value_tiers", f"""
    select case when lifetime_value >= 10000 then 'VIP' when lifetime_value >= 5000 then 'High Value'
                when lifetime_value >= 1000 then 'Medium Value' else 'Low Value' end as value_tier,
           count(*) as customer_count, {sql_round(sql_ratio('sum(lifetime_value)', 'count(lifetime_value)'))} as avg_lifetime_value,
           {sql_money('sum(lifetime_value)')} as total_revenue,
           {sql_round(sql_ratio('sum(total_orders)', 'count(total_orders)'), 1)} as avg_orders_per_customer
    from dim_customer where is_current group by 1""")
def _(c: Context) -> DataFrame:
    return analytics.value_tiers(c["dim_customer"])


define("recency", f"""
    select customer_key, datediff('day', max(date_actual), {DAY}) as days from dated_sales group by customer_key""")


@query("Q03_churn_by_segment", f"""
    select customer_segment, count(distinct c.customer_key) as total_customers,
           count(distinct case when days > 180 then c.customer_key end) as at_risk_customers,
           {sql_percent('count(distinct case when days > 180 then c.customer_key end)', 'count(distinct c.customer_key)')}
               as churn_risk_percentage
    from dim_customer c left join recency r on c.customer_key = r.customer_key
    where is_current group by customer_segment""")
def _(c: Context) -> DataFrame:
    return analytics.churn_by_segment(c["dim_customer"], c["fact_transactions"], c["dim_date"], SALES_AS_OF)


@query("Q04_monthly_revenue", f"""
    select year_number, month_name, month_number, count(distinct transaction_id) as total_transactions,
           count(distinct customer_key) as unique_customers, cast(sum(quantity) as bigint) as total_units_sold,
           {sql_money('sum(net_amount)')} as total_revenue, {sql_money('sum(discount_amount)')} as total_discounts,
           {sql_round(sql_ratio('sum(net_amount)', 'count(net_amount)'))} as avg_transaction_value
    from dated_sales where date_actual >= cast({DAY} - interval 12 month as date)
    group by year_number, month_name, month_number""")
def _(c: Context) -> DataFrame:
    return analytics.monthly_revenue(c["fact_transactions"], c["dim_date"], SALES_AS_OF)


@query("Q05_weekday_revenue", f"""
    select *, {sql_percent('total_revenue', 'sum(total_revenue) over ()')} as revenue_percentage
    from (select day_name, day_of_week, count(distinct transaction_id) as total_transactions,
                 {sql_money('sum(net_amount)')} as total_revenue,
                 {sql_round(sql_ratio('sum(net_amount)', 'count(net_amount)'))} as avg_transaction_value
          from dated_sales group by day_name, day_of_week) q""")
def _(c: Context) -> DataFrame:
    return analytics.weekday_revenue(c["fact_transactions"], c["dim_date"])


define("month_revenue", f"""
    select year_number, month_number, {sql_money('sum(net_amount)')} as revenue
    from dated_sales group by year_number, month_number""")


@query("Q06_year_over_year", f"""
    select a.year_number as current_year, a.month_number, a.revenue as current_year_revenue,
           b.revenue as previous_year_revenue, {sql_money('a.revenue - b.revenue')} as revenue_change,
           {sql_percent('(a.revenue - b.revenue)', 'b.revenue')} as yoy_growth_percentage
    from month_revenue a join month_revenue b on a.month_number = b.month_number and a.year_number = b.year_number + 1""")
def _(c: Context) -> DataFrame:
    return analytics.year_over_year(c["fact_transactions"], c["dim_date"])


@query("Q07_top_products", f"""
    select product_id, product_name, product_category, product_subcategory, brand,
           cast(sum(quantity) as bigint) as units_sold, count(distinct transaction_id) as times_purchased,
           {sql_money('sum(net_amount)')} as total_revenue,
           {sql_round(sql_ratio('sum(unit_price)', 'count(unit_price)'))} as avg_selling_price,
           retail_price as list_price, margin_percentage as margin_pct
    from fact_transactions f join dim_product p on f.product_key = p.product_key
    group by all order by total_revenue desc, product_id limit 20""")
def _(c: Context) -> DataFrame:
    return analytics.top_products(c["fact_transactions"], c["dim_product"])


@query("Q07_best_sellers", f"""
    select product_id, product_name, cast(sum(quantity) as bigint) as units_sold, {sql_money('sum(net_amount)')} as total_revenue
    from fact_transactions f join dim_product p on f.product_key = p.product_key
    where transaction_date_key between 20000301 and 20000831
    group by all order by units_sold desc, product_id limit 15""")
def _(c: Context) -> DataFrame:
    best = analytics.top_products(
        c["fact_transactions"], c["dim_product"], 15, "units_sold", dt.date(2000, 3, 1), dt.date(2000, 8, 31))
    return best.select("product_id", "product_name", "units_sold", "total_revenue")


@query("Q08_category_performance", f"""
    select product_category, count(distinct p.product_key) as product_count,
           cast(sum(quantity) as bigint) as total_units_sold, count(distinct customer_key) as unique_customers,
           {sql_money('sum(net_amount)')} as total_revenue,
           {sql_round(sql_ratio('sum(net_amount)', 'count(net_amount)'))} as avg_transaction_value,
           {sql_money('sum(net_amount - quantity * unit_cost)')} as total_profit,
           {sql_percent('sum(net_amount - quantity * unit_cost)', 'sum(net_amount)')} as profit_margin_pct
    from fact_transactions f join dim_product p on f.product_key = p.product_key group by product_category""")
def _(c: Context) -> DataFrame:
    return analytics.category_performance(c["fact_transactions"], c["dim_product"])


@query("Q09_product_affinity", f"""
    select p1.product_name as product_1, p2.product_name as product_2,
           count(distinct f1.transaction_id) as times_bought_together,
           {sql_round(sql_ratio('sum(f1.net_amount + f2.net_amount)', 'count(*)'))} as avg_combined_value
    from fact_transactions f1
    join fact_transactions f2 on f1.transaction_id = f2.transaction_id and f1.product_key < f2.product_key
    join dim_product p1 on f1.product_key = p1.product_key
    join dim_product p2 on f2.product_key = p2.product_key
    group by all having count(distinct f1.transaction_id) >= 5
    order by times_bought_together desc, product_1, product_2 limit 20""")
def _(c: Context) -> DataFrame:
    return analytics.product_affinity(c["fact_transactions"], c["dim_product"])


define("answered", """
    select k.*, r.customer_key, r.is_opened, r.is_clicked, r.is_converted, r.conversion_value
    from dim_campaign k left join fact_campaign_responses r on k.campaign_key = r.campaign_key""")


@query("Q10_campaign_roi", f"""
    select campaign_id, campaign_name, campaign_type, channel, strftime(start_date, '%Y-%m-%d') as start_date,
           strftime(end_date, '%Y-%m-%d') as end_date, duration_days, budget,
           count(distinct customer_key) as total_responses, count(*) filter (where is_converted) as conversions,
           {sql_percent('count(*) filter (where is_converted)', 'count(distinct customer_key)')} as conversion_rate,
           {sql_money('sum(conversion_value)')} as total_conversion_value,
           {sql_money('sum(conversion_value) - budget')} as roi_amount,
           {sql_percent('(sum(conversion_value) - budget)', 'budget')} as roi_percentage
    from answered where campaign_status = 'Completed'
    group by campaign_id, campaign_name, campaign_type, channel, answered.start_date, answered.end_date, duration_days, budget""")
def _(c: Context) -> DataFrame:
    return analytics.campaign_roi(c["dim_campaign"], c["fact_campaign_responses"])


@query("Q11_campaign_funnel", f"""
    select campaign_name, channel, count(distinct customer_key) as total_reached,
           count(*) filter (where is_opened) as opened, count(*) filter (where is_clicked) as clicked,
           count(*) filter (where is_converted) as converted,
           {sql_percent('count(*) filter (where is_opened)', 'count(distinct customer_key)')} as open_rate,
           {sql_percent('count(*) filter (where is_clicked)', 'count(*) filter (where is_opened)')} as click_through_rate,
           {sql_percent('count(*) filter (where is_converted)', 'count(*) filter (where is_clicked)')} as conversion_rate
    from answered where campaign_status = 'Completed' group by campaign_name, channel""")
def _(c: Context) -> DataFrame:
    return analytics.campaign_funnel(c["dim_campaign"], c["fact_campaign_responses"])


@query("Q12_cohorts", f"""
    select strftime(registration_date, '%Y-%m') as cohort_month, count(distinct c.customer_key) as cohort_size,
           {sql_money('sum(net_amount)')} as total_revenue,
           {sql_round(sql_ratio('sum(total_spent)', 'count(total_spent)'))} as avg_customer_value,
           {sql_round(sql_ratio('sum(total_orders)', 'count(total_orders)'), 1)} as avg_orders_per_customer
    from dim_customer c left join fact_transactions f on c.customer_key = f.customer_key
    where is_current group by 1""")
def _(c: Context) -> DataFrame:
    return analytics.cohorts(c["dim_customer"], c["fact_transactions"])


def _micro_mean(x: str) -> str:
    return f"(cast(sum(cast(floor({x} * 1000000e0 + 0.5e0) as decimal(28,0))) as double) / 1000000e0 / count(*))"


@query("Q13_clv_segments", f"""
    select case when total_spent >= 5000 then 'High CLV' when total_spent >= 1000 then 'Medium CLV' else 'Low CLV' end
               as clv_segment,
           count(*) as customer_count, {sql_round(sql_ratio('sum(total_spent)', 'count(*)'))} as avg_lifetime_value,
           {sql_round(sql_ratio('sum(total_orders)', 'count(*)'), 1)} as avg_orders,
           {sql_round(_micro_mean(sql_ratio('total_spent', 'total_orders')))} as avg_order_value,
           {sql_round(_micro_mean(sql_ratio(f"datediff('day', registration_date, {DAY})", 'total_orders')), 1)}
               as avg_days_between_orders
    from dim_customer where is_current and total_orders > 0 group by 1""")
def _(c: Context) -> DataFrame:
    return analytics.clv_segments(c["dim_customer"], SALES_AS_OF)


@query("Q14_state_revenue", f"""
    select *, {sql_percent('total_revenue', 'sum(total_revenue) over ()')} as revenue_percentage
    from (select state, count(distinct c.customer_key) as customer_count, {sql_money('sum(net_amount)')} as total_revenue,
                 {sql_round(sql_ratio('sum(total_spent)', 'count(total_spent)'))} as avg_customer_value
          from dim_customer c join fact_transactions f on c.customer_key = f.customer_key
          where is_current group by state) q
    order by total_revenue desc, state limit 20""")
def _(c: Context) -> DataFrame:
    return analytics.state_revenue(c["dim_customer"], c["fact_transactions"])


@query("Q15_dimension_completeness", f"""
    select 'Customer' as dimension, count(*) as total_records, count(*) - count(email) as missing_email,
           count(*) - count(phone_number) as missing_phone, {sql_percent('count(*) - count(email)', 'count(*)')} as email_null_pct
    from dim_customer where is_current
    union all
    select 'Product', count(*), count(*) - count(product_category), count(*) - count(brand),
           {sql_percent('count(*) - count(product_category)', 'count(*)')}
    from dim_product""")
def _(c: Context) -> DataFrame:
    return analytics.dimension_completeness(c["dim_customer"], c["dim_product"])
