"""Key figures over the warehouse."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.catalog import quality_queries, scans
from tillstar.catalog.base import (
    SALES_AS_OF, Context, define, query, sql_money, sql_percent, sql_ratio,
)
from tillstar.catalog.fact_queries import _fact_view, _orphan_sql, damaged
from tillstar.plans import kpis, validation
from tillstar.sources import files
from tillstar.sources.tables import TableStore

DAY = f"date '{SALES_AS_OF}'"


def _share(num: str, den: str) -> str:
    return sql_percent(num, den, None)


define("sold", "select f.*, c.customer_id from fact_transactions f join dim_customer c on f.customer_key = c.customer_key")


@query("K01_active_customers", f"""
    select count(distinct customer_id) as active_customers from sold s join dim_date d on s.transaction_date_key = d.date_key
    where d.date_actual >= cast({DAY} - interval 12 month as date)""")
def _(c: Context) -> DataFrame:
    return kpis.active_customers(c["fact_transactions"], c["dim_customer"], SALES_AS_OF)


@query("K02_lifetime_value", f"""
    select coalesce(customer_segment, 'ALL') as segment, count(*) as customers, {sql_ratio('sum(total_spent)', 'count(*)')} as average_lifetime_value
    from dim_customer where is_current and total_orders > 0 group by grouping sets ((), (customer_segment))""")
def _(c: Context) -> DataFrame:
    return kpis.lifetime_value(c["dim_customer"]).withColumn("customers", F.col("customers").cast("bigint"))


@query("K02_lifetime_value_per_customer", f"""
    select count(*) as customers, {sql_ratio('sum(net)', 'count(*)')} as average_lifetime_value
    from (select customer_id, sum(net_amount) as net from sold group by customer_id) q""")
def _(c: Context) -> DataFrame:
    return kpis.lifetime_value_per_customer(c["fact_transactions"], c["dim_customer"])


@query("K03_registrations", """
    select strftime(first, '%Y-%m') as month, count(*) as new_customers
    from (select customer_id, min(registration_date) as first from dim_customer group by 1) q group by 1""")
def _(c: Context) -> DataFrame:
    return kpis.registrations(c["dim_customer"])


@query("K04_churn_rate", f"""
    select count(*) as customers, count(*) filter (where late) as churned, {_share('count(*) filter (where late)', 'count(*)')} as churn_rate
    from (select c.customer_id, datediff('day', max(d.date_actual), {DAY}) > 180 as late
          from dim_customer c left join sold s on c.customer_id = s.customer_id
          left join dim_date d on s.transaction_date_key = d.date_key where c.is_current group by 1) q""")
def _(c: Context) -> DataFrame:
    return kpis.churn_rate(c["dim_customer"], c["fact_transactions"], c["dim_date"], SALES_AS_OF)


@query("K05_repeat_rate", f"""
    select count(*) as buyers, count(*) filter (where orders >= 2) as repeat_buyers,
           {_share('count(*) filter (where orders >= 2)', 'count(*)')} as repeat_rate
    from (select customer_id, count(distinct transaction_id) as orders from sold group by 1) q""")
def _(c: Context) -> DataFrame:
    return kpis.repeat_rate(c["fact_transactions"], c["dim_customer"])


@query("K06_total_revenue", f"""
    select quarter_start_date as period_start, {sql_money('sum(net_amount)')} as total_revenue from dated_sales group by 1""")
def _(c: Context) -> DataFrame:
    return kpis.revenue_per_period(c["fact_transactions"], c["dim_date"], "quarter")


@query("K07_average_order_value", f"""
    select year_number, month_number, count(*) as transactions, {sql_money('sum(net)')} as revenue,
           {sql_ratio(sql_money('sum(net)'), 'count(*)')} as average_order_value
    from (select transaction_id, year_number, month_number, sum(net_amount) as net from dated_sales group by all) q
    where net <= 10000 group by 1, 2""")
def _(c: Context) -> DataFrame:
    return kpis.average_order_value(c["fact_transactions"], c["dim_date"])


@query("K08_month_over_month", f"""
    select month_start, revenue, previous_revenue, {_share('(revenue - previous_revenue)', 'previous_revenue')} as growth_percentage
    from (select month_start, revenue, lag(revenue) over (order by month_start) as previous_revenue
          from (select m.month_start, {sql_money('coalesce(r.revenue, 0)')} as revenue
                from (select distinct month_start_date as month_start from dim_date
                      where date_actual between (select min(date_actual) from dated_sales) and (select max(date_actual) from dated_sales)) m
                left join (select month_start_date, sum(net_amount) as revenue from dated_sales group by 1) r
                  on m.month_start = r.month_start_date) a) b""")
def _(c: Context) -> DataFrame:
    return kpis.month_over_month(c["fact_transactions"], c["dim_date"])


@query("K09_year_over_year", f"""
    select a.year_number, a.month_number, {sql_percent('(a.revenue - b.revenue)', 'b.revenue')} as growth_percentage
    from month_revenue a join month_revenue b on a.month_number = b.month_number and a.year_number = b.year_number + 1""")
def _(c: Context) -> DataFrame:
    return kpis.year_over_year(c["fact_transactions"], c["dim_date"])


@query("K10_revenue_by_segment", f"""
    select *, {sql_percent('revenue', 'sum(revenue) over ()')} as revenue_share
    from (select c.customer_segment, {sql_money('sum(net_amount)')} as revenue
          from sold s join dim_customer c on s.customer_id = c.customer_id and c.is_current group by 1) q""")
def _(c: Context) -> DataFrame:
    return kpis.revenue_by_segment(c["fact_transactions"], c["dim_customer"])


@query("K11_units_sold", """
    select month_start_date as period_start, cast(sum(quantity) as bigint) as units_sold from dated_sales group by 1""")
def _(c: Context) -> DataFrame:
    return kpis.units_per_period(c["fact_transactions"], c["dim_date"])


@query("K12_top_products", f"""
    select *, {sql_percent('revenue', '(select sum(net_amount) from fact_transactions)')} as revenue_share
    from (select product_id, product_name, {sql_money('sum(net_amount)')} as revenue
          from fact_transactions f join dim_product p on f.product_key = p.product_key group by 1, 2) q
    order by revenue desc, product_id limit 10""")
def _(c: Context) -> DataFrame:
    return kpis.top_products(c["fact_transactions"], c["dim_product"])


_PERIOD = "transaction_date_key between 20000301 and 20000831"


@query("K12_top_products_of_a_period", f"""
    select *, {sql_percent('revenue', f'(select sum(net_amount) from fact_transactions where {_PERIOD})')} as revenue_share
    from (select product_id, product_name, {sql_money('sum(net_amount)')} as revenue
          from fact_transactions f join dim_product p on f.product_key = p.product_key where {_PERIOD} group by 1, 2) q
    order by revenue desc, product_id limit 10""")
def _(c: Context) -> DataFrame:
    return kpis.top_products(
        c["fact_transactions"], c["dim_product"], first=dt.date(2000, 3, 1), last=dt.date(2000, 8, 31))


@query("K13_category_performance", f"""
    select product_category, {sql_money('sum(net_amount)')} as total_revenue, cast(sum(quantity) as bigint) as total_units_sold,
           {sql_percent('sum(net_amount - quantity * unit_cost)', 'sum(net_amount)')} as profit_margin_pct
    from fact_transactions f join dim_product p on f.product_key = p.product_key group by 1""")
def _(c: Context) -> DataFrame:
    return kpis.category_performance(c["fact_transactions"], c["dim_product"])


@query("K14_weighted_margin", f"""
    select cast(sum(quantity) as bigint) as units, {sql_ratio('sum(margin_percentage * quantity)', 'sum(quantity)')} as average_margin
    from fact_transactions f join dim_product p on f.product_key = p.product_key""")
def _(c: Context) -> DataFrame:
    return kpis.weighted_margin(c["fact_transactions"], c["dim_product"])


@query("K16_campaign_roi", f"""
    select campaign_id, channel, budget, {sql_money('coalesce(sum(conversion_value) filter (where is_converted), 0)')} as revenue,
           {_share('(coalesce(sum(conversion_value) filter (where is_converted), 0) - budget)', 'budget')} as roi
    from answered where campaign_status = 'Completed' group by campaign_id, channel, budget""")
def _(c: Context) -> DataFrame:
    return kpis.campaign_roi(c["dim_campaign"], c["fact_campaign_responses"])


@query("K17_channel_conversion", f"""
    select channel, count(*) as reached, count(*) filter (where won) as converted,
           {_share('count(*) filter (where won)', 'count(*)')} as conversion_rate
    from (select t.customer_key, k.channel,
                 exists (select 1 from fact_campaign_responses r join dim_date d on r.response_date_key = d.date_key
                         where r.customer_key = t.customer_key and r.campaign_key = t.campaign_key and r.is_converted
                           and datediff('day', k.start_date, d.date_actual) between 0 and 30) as won
          from (select customer_key, arg_min(campaign_key, (response_date_key, campaign_key)) as campaign_key
                from fact_campaign_responses group by 1) t
          join dim_campaign k on t.campaign_key = k.campaign_key) q
    group by 1""")
def _(c: Context) -> DataFrame:
    return kpis.channel_conversion(c["dim_campaign"], c["fact_campaign_responses"], c["dim_date"])


@query("K18_cost_per_acquisition", f"""
    select campaign_id, budget, count(*) filter (where is_converted) as conversions,
           {sql_ratio('budget', 'count(*) filter (where is_converted)')} as cost_per_acquisition
    from answered group by campaign_id, budget""")
def _(c: Context) -> DataFrame:
    return kpis.cost_per_acquisition(c["dim_campaign"], c["fact_campaign_responses"])


@query("K19_email_open_rate", f"""
    select campaign_id, count(distinct customer_key) as reached, count(*) filter (where is_opened) as opened,
           {_share('count(*) filter (where is_opened)', 'count(distinct customer_key)')} as open_rate
    from answered where channel = 'Email' group by 1""")
def _(c: Context) -> DataFrame:
    return kpis.email_open_rate(c["dim_campaign"], c["fact_campaign_responses"])


@query("K20_email_click_through", f"""
    select campaign_id, count(*) filter (where is_opened) as opened, count(*) filter (where is_clicked) as clicked,
           {_share('count(*) filter (where is_clicked)', 'count(*) filter (where is_opened)')} as click_through_rate
    from answered where channel = 'Email' group by 1""")
def _(c: Context) -> DataFrame:
    return kpis.email_click_through(c["dim_campaign"], c["fact_campaign_responses"])


@query("K21_load_success_rate", f"""
    select cast({len(schemas.SOURCE) + 1} as bigint) as loads, cast({len(schemas.SOURCE)} as bigint) as succeeded,
           {_share(str(len(schemas.SOURCE)), str(len(schemas.SOURCE) + 1))} as success_rate, count(*) as staged_rows
    from stg_ecom_transactions""")
def _(c: Context) -> DataFrame:
    # six loads that succeed and one that finds no file
    store = TableStore(c.spark, c.scratch("audit"))
    files.load_all(store, scans.csv_folder(c), now=scans.LOAD_TIME)
    try:
        files.load_source(store, "stg_products", f"{scans.csv_folder(c)}/empty", now=scans.LOAD_TIME)
    except FileNotFoundError:
        pass
    staged = store.read("stg_ecom_transactions").agg(F.count(F.lit(1))).scalar()
    return kpis.load_success_rate(store.read("stg_audit_log")).withColumn("staged_rows", staged)


@query("K22_freshness", """
    select count(*) as records, datediff('hour', max(cast(response_date as timestamp)), max(cast(load_day as timestamp))) as lag_hours
    from stg_campaign_responses""")
def _(c: Context) -> DataFrame:
    return kpis.freshness(c.stg("stg_campaign_responses"), "response_date")


@query("K25_overall_quality", """
    select report_date, overall_quality_score,
           case when overall_quality_score >= 95 then 'EXCELLENT' when overall_quality_score >= 80 then 'GOOD'
                when overall_quality_score >= 60 then 'FAIR' else 'NEEDS ATTENTION' end as score_band
    from dq_scorecards""")
def _(c: Context) -> DataFrame:
    return kpis.overall_quality(quality_queries.dq(c)["dq_scorecards"])


REQUIRED = ("customer_id", "email", "phone_number", "full_name", "gender", "registration_date")


@query("K26_completeness", " union all ".join(
    f"""select 'dim_customer' as table_name, '{x}' as column_name, count(*) as records, count({x}) as filled,
               {_share(f'count({x})', 'count(*)')} as completeness,
               case when {_share(f'count({x})', 'count(*)')} > 95 then 'OK' when {_share(f'count({x})', 'count(*)')} >= 80
                    then 'WARNING' else 'FAILURE' end as band from dim_customer""" for x in REQUIRED))
def _(c: Context) -> DataFrame:
    return kpis.completeness(c["dim_customer"], "dim_customer", REQUIRED)


@query("K27_accuracy", f"""
    select cast(sum(total_records_checked) as bigint) as checked, cast(sum(passed_records) as bigint) as passed,
           {_share('sum(passed_records)', 'sum(total_records_checked)')} as accuracy
    from dq_test_results t join dq_rules r on t.rule_id = r.rule_id join dq_rule_categories k on r.category_id = k.category_id
    where category_name in ('Accuracy', 'Validity') and cast(execution_date as date) = {DAY}""")
def _(c: Context) -> DataFrame:
    q = quality_queries.dq(c)
    return kpis.accuracy(q["dq_test_results"], q["dq_rules"], q["dq_rule_categories"], SALES_AS_OF)


@query("K28_referential_integrity", " union all ".join(
    f"""select '{f}' as fact_table, '{k}' as fk_column, count(*) as records, {_orphan_sql(_fact_view(f), k, d, dk)} as orphan_count,
               {_share(f'(count(*) - {_orphan_sql(_fact_view(f), k, d, dk)})', 'count(*)')} as integrity from {_fact_view(f)}"""
    for f, k, d, dk in validation.REFERENCES))
def _(c: Context) -> DataFrame:
    return kpis.referential_integrity(damaged(c))


@query("K29_duplicate_rate", f"""
    select count(*) as records, count(*) - count(distinct customer_id) as duplicates,
           {_share('(count(*) - count(distinct customer_id))', 'count(*)')} as duplicate_rate
    from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    return kpis.duplicate_rate(c.stg("stg_crm_customers"), ["customer_id"])


@query("K30_on_time_rate", f"""
    select count(*) as records, count(*) filter (where late <= 20 * 24 * 3600) as on_time,
           {_share('count(*) filter (where late <= 20 * 24 * 3600)', 'count(*)')} as on_time_rate
    from (select epoch(cast(load_day as timestamp)) - epoch(cast(response_date as timestamp)) as late
          from stg_campaign_responses) q""")
def _(c: Context) -> DataFrame:
    return kpis.on_time_rate(c.stg("stg_campaign_responses"), "response_date", 20 * 24)
