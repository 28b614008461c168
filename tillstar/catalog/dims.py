"""Dimension builds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.catalog.base import FIRST_LOAD, SECOND_LOAD, Context, define, query, sql_percent
from tillstar.operators import scd
from tillstar.operators.keys import with_keys
from tillstar.plans import dimensions, warehouse
from tillstar.sources.tables import TableStore

PRODUCT = (
    "product_key, product_id, product_name, product_category, product_subcategory, brand, unit_cost, retail_price, "
    "margin_percentage, product_status, is_active"
)
CAMPAIGN = (
    "campaign_key, campaign_id, campaign_name, campaign_type, channel, start_date, end_date, duration_days, budget, "
    "target_audience, campaign_status"
)
CUSTOMER = (
    "customer_key, customer_id, full_name, email, phone_number, age, age_group, city, state, customer_segment, "
    "account_status, valid_from, valid_to, is_current"
)


def cols(text: str) -> list[str]:
    return text.split(", ")


@query("D01_build_product", f"select {PRODUCT} from dim_product")
def _(c: Context) -> DataFrame:
    return dimensions.build_product(c.stg("stg_products")).select(*cols(PRODUCT))


define("repriced", f"""
    select product_id, retail_price, product_status,
           cast({sql_percent('retail_price - unit_cost', 'retail_price')} as decimal(9,2)) as margin_percentage
    from stg_products_second""")


@query("D02_scd1_upsert", """
    select p.product_key, p.product_id, coalesce(s.retail_price, p.retail_price) as retail_price,
           coalesce(s.margin_percentage, p.margin_percentage) as margin_percentage, p.unit_cost, p.brand
    from (select row_number() over (order by product_id) as product_key, * exclude (product_key)
          from dim_product where cast(substring(product_id, 5, 20) as bigint) % 5 <> 0) p
    left join repriced s on p.product_id = s.product_id
    union all
    select (select count(*) from dim_product where cast(substring(product_id, 5, 20) as bigint) % 5 <> 0)
           + row_number() over (order by s.product_id),
           s.product_id, s.retail_price, s.margin_percentage, p.unit_cost, p.brand
    from repriced s join dim_product p on s.product_id = p.product_id
    where cast(substring(s.product_id, 5, 20) as bigint) % 5 = 0""")
def _(c: Context) -> DataFrame:
    # the first price list lacks every fifth product, so the second both updates and inserts
    number = F.substring("product_id", 5, 20).cast("bigint")
    first = dimensions.build_product(c.stg("stg_products").filter(number % 5 != 0))
    return dimensions.upsert_product(first, c.stg("stg_products_second")).select(
        "product_key", "product_id", "retail_price", "margin_percentage", "unit_cost", "brand"
    )


@query("D03_build_campaign", f"select {CAMPAIGN} from dim_campaign")
def _(c: Context) -> DataFrame:
    return dimensions.build_campaign(c.stg("stg_marketing_campaigns")).select(*cols(CAMPAIGN))


@query("D04_insert_only_campaign", """
    select n as campaign_key, campaign_id, budget
    from (select row_number() over (order by case when campaign_status = 'Planned' then 1 else 0 end, campaign_id) as n,
                 campaign_id,
                 budget
          from stg_marketing_campaigns) x""")
def _(c: Context) -> DataFrame:
    # planned campaigns arrive later; the budgets staged with them do not touch known campaigns
    staged = c.stg("stg_marketing_campaigns")
    known = dimensions.build_campaign(staged.filter("campaign_status <> 'Planned'"))
    later = staged.withColumn(
        "budget", F.when(F.col("campaign_status") == "Planned", F.col("budget")).otherwise(F.lit(0).cast("decimal(12,2)"))
    )
    return dimensions.load_campaign(known, later).select("campaign_key", "campaign_id", "budget")


@query("D05_keep_latest_customer", "select customer_id, city, state, email from whole_snapshot")
def _(c: Context) -> DataFrame:
    latest = dimensions.derive_customer(c.stg("stg_crm_customers"), FIRST_LOAD)
    return latest.select("customer_id", "city", "state", "email")


@query("D06_customer_derivations", "select customer_id, full_name, age, age_group from whole_snapshot")
def _(c: Context) -> DataFrame:
    latest = dimensions.derive_customer(c.stg("stg_crm_customers"), FIRST_LOAD)
    return latest.select("customer_id", "full_name", "age", "age_group")


def _classified(c: Context) -> DataFrame:
    staged = dimensions.derive_customer(c.stg("stg_customers_second"), SECOND_LOAD)
    return scd.classify(c.first_load(), staged, "customer_id", dimensions.TRACKED, dimensions.IN_PLACE)


def _verdicts(c: Context) -> DataFrame:
    new = [F.col(x).alias(f"_new_{x}") for x in dimensions.IN_PLACE]
    verdict = _classified(c).select("customer_id", "change", *new)
    return c.first_load().join(verdict, "customer_id", "left")


@query("D07_scd2_classify", "select customer_id, change from change_labels")
def _(c: Context) -> DataFrame:
    return _classified(c).select("customer_id", "change")


@query("D08_scd2_expire", "select customer_key, customer_id, city, valid_to, is_current from customers_merged "
       "where not is_current")
def _(c: Context) -> DataFrame:
    expired = scd.expire(_verdicts(c), SECOND_LOAD).filter("not is_current")
    return expired.select("customer_key", "customer_id", "city", "valid_to", "is_current")


@query("D09_scd2_insert", """
    select customer_id, city, valid_from, valid_to, is_current, cast(0 as bigint) as total_orders
    from customers_merged where customer_key > (select max(customer_key) from customers_initial)""")
def _(c: Context) -> DataFrame:
    opened = scd.new_versions(_classified(c), SECOND_LOAD, "registration_date")
    return opened.select(
        "customer_id", "city", "valid_from", "valid_to", "is_current", F.lit(0).cast("bigint").alias("total_orders")
    )


@query("D10_type1_in_place", """
    select m.customer_id, m.email, m.phone_number
    from customers_merged m join change_labels l on m.customer_id = l.customer_id
    where l.change = 'type1_changed'""")
def _(c: Context) -> DataFrame:
    touched = scd.overwrite_in_place(_verdicts(c), dimensions.IN_PLACE).filter("change = 'type1_changed'")
    return touched.select("customer_id", "email", "phone_number")


@query("D11_scd2_merge", f"select {CUSTOMER} from customers_merged")
def _(c: Context) -> DataFrame:
    merged = dimensions.merge_customer(c.first_load(), c.stg("stg_customers_second"), SECOND_LOAD)
    return merged.dim.select(*cols(CUSTOMER))


@query("D11_scd2_change_counts", "select change, count(*) as customers from change_labels group by change")
def _(c: Context) -> DataFrame:
    return dimensions.merge_customer(c.first_load(), c.stg("stg_customers_second"), SECOND_LOAD).changes


@query("D11_scd2_copy_on_write", f"select {CUSTOMER} from customers_merged")
def _(c: Context) -> DataFrame:
    store = TableStore(c.spark, c.scratch("buckets"))
    warehouse.load_customers(store, c.stg("stg_customers_first"), FIRST_LOAD)
    warehouse.load_customers(store, c.stg("stg_customers_second"), SECOND_LOAD)
    return store.read("dim_customer").select(*cols(CUSTOMER))


@query("D12_surrogate_keys", """
    select row_number() over (order by customer_id, transaction_id) as sales_key, customer_id, transaction_id
    from stg_ecom_transactions""")
def _(c: Context) -> DataFrame:
    rows = c.stg("stg_ecom_transactions").select("customer_id", "transaction_id")
    return with_keys(rows, "sales_key", ["customer_id", "transaction_id"])


@query("D13_date_dimension", """
    select d.* from dim_date d
    where d.date_actual between (select min(transaction_date) from stg_ecom_transactions)
                            and (select max(transaction_date) from stg_ecom_transactions)""")
def _(c: Context) -> DataFrame:
    first, last = (
        c.stg("stg_ecom_transactions").agg(F.min("transaction_date"), F.max("transaction_date")).first()
    )
    return dimensions.build_date(c.spark, first.date(), last.date())


@query("D14_lifetime_metrics", "select customer_key, customer_id, total_orders, total_spent, lifetime_value, is_current "
       "from dim_customer")
def _(c: Context) -> DataFrame:
    updated = dimensions.with_lifetime_metrics(c.dim("dim_customer"), c["fact_transactions"])
    return updated.select("customer_key", "customer_id", "total_orders", "total_spent", "lifetime_value", "is_current")


@query("D15_all_dimensions", """
    select 'products' as dimension, count(*) as loaded from dim_product
    union all select 'campaigns', count(*) from dim_campaign
    union all select 'customers_new', count(*) from whole_snapshot
    union all select 'customers_updated', 0
    union all select 'customers_unchanged', 0""")
def _(c: Context) -> DataFrame:
    store = TableStore(c.spark, c.scratch("dimensions"))
    counts = warehouse.load_dimensions(store, c.staged(), FIRST_LOAD)
    rows = [(k, int(v)) for k, v in counts.items()]
    return c.spark.createDataFrame(rows, "dimension string, loaded bigint")
