"""Fact builds, aggregates, whole loads and validation."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.catalog.base import (
    FIRST_LOAD, Context, _fact_sql, define, query, sql_money, sql_percent, sql_ratio,
)
from tillstar.functions import date_key, decimal_sum, row_count
from tillstar.operators.lookup import lookup_scd2
from tillstar.plans import facts, validation, warehouse
from tillstar.sources.tables import TableStore

FACT = [n for n in schemas.WAREHOUSE["fact_transactions"].names if n != "source_system"]
RESPONSE = [n for n in schemas.WAREHOUSE["fact_campaign_responses"].names if n != "source_system"]


def _sources(c: Context) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (
        c.stg("stg_ecom_transactions"), c.stg("stg_ecom_transaction_items"), c.dim("dim_customer"), c.dim("dim_product"),
    )


@query("F01_fact_transactions", f"select {', '.join(FACT)} from fact_transactions")
def _(c: Context) -> DataFrame:
    return facts.build_transactions(*_sources(c)).select(*FACT)


@query("F01_fact_transactions_inclusive", f"select {', '.join(FACT)} from fact_inclusive")
def _(c: Context) -> DataFrame:
    return facts.build_transactions(*_sources(c), inclusive=True).select(*FACT)


@query("F02_scd2_key_lookup", """
    select r.response_id, r.customer_id, c.customer_key, c.city from stg_campaign_responses r
    join customers_merged c on r.customer_id = c.customer_id
     and r.response_date >= c.valid_from and r.response_date < c.valid_to""")
def _(c: Context) -> DataFrame:
    found = lookup_scd2(
        c.stg("stg_campaign_responses"), c.dim("dim_customer"), "customer_id", "response_date", "customer_key", "city"
    )
    return found.select("response_id", "customer_id", "customer_key", "city")


@query("F03_net_amount", """
    select transaction_id, product_id, line_total, discount_amount,
           cast(line_total - discount_amount as decimal(12,2)) as net_amount
    from stg_ecom_transaction_items""")
def _(c: Context) -> DataFrame:
    net = (F.col("line_total") - F.col("discount_amount")).cast("decimal(12,2)")
    return c.stg("stg_ecom_transaction_items").select(
        "transaction_id", "product_id", "line_total", "discount_amount", net.alias("net_amount")
    )


@query("F04_date_key", """
    select transaction_id, cast(strftime(transaction_date, '%Y%m%d') as int) as transaction_date_key
    from stg_ecom_transactions""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_ecom_transactions").select(
        "transaction_id", date_key("transaction_date").alias("transaction_date_key")
    )


def _summary_sql(view: str) -> str:
    return f"""
    select count(*) as lines, count(distinct transaction_id) as transactions, {sql_money('sum(net_amount)')} as net,
           count(distinct transaction_key) as keys, max(transaction_key) as last_key from {view}"""


def _summary(fact: DataFrame) -> DataFrame:
    return fact.agg(
        row_count().alias("lines"), F.count_distinct("transaction_id").alias("transactions"),
        decimal_sum("net_amount").alias("net"), F.count_distinct("transaction_key").alias("keys"),
        F.max("transaction_key").alias("last_key"),
    )


@query("F05_idempotent_transactions", _summary_sql("fact_transactions"))
def _(c: Context) -> DataFrame:
    # even orders first, then everything twice: the second pass adds the rest, the third nothing
    transactions, items, customer, product = _sources(c)
    store = TableStore(c.spark, c.scratch("fact"))
    store.replace(customer, "dim_customer")
    store.replace(product, "dim_product")
    even = transactions.filter(F.substring("transaction_id", 4, 20).cast("bigint") % 2 == 0)
    for batch in (even, transactions, transactions):
        warehouse.load_transactions(store, batch, items)
    return _summary(store.read("fact_transactions"))


@query("F06_fact_campaign_responses", f"select {', '.join(RESPONSE)} from fact_campaign_responses")
def _(c: Context) -> DataFrame:
    built = facts.build_responses(c.stg("stg_campaign_responses"), c.dim("dim_customer"), c.dim("dim_campaign"))
    return built.select(*RESPONSE)


@query("F07_idempotent_responses", """
    select count(*) as responses, count(distinct response_id) as ids, count(distinct response_key) as keys,
           max(response_key) as last_key from fact_campaign_responses""")
def _(c: Context) -> DataFrame:
    responses = c.stg("stg_campaign_responses")
    store = TableStore(c.spark, c.scratch("responses"))
    store.replace(c.dim("dim_customer"), "dim_customer")
    store.replace(c.dim("dim_campaign"), "dim_campaign")
    for batch in (responses.filter("response_type = 'opened'"), responses, responses):
        warehouse.load_responses(store, batch)
    return store.read("fact_campaign_responses").agg(
        row_count().alias("responses"), F.count_distinct("response_id").alias("ids"),
        F.count_distinct("response_key").alias("keys"), F.max("response_key").alias("last_key"),
    )


define("agg_customer_monthly", f"""
    select customer_key, cast(year_number * 100 + month_number as int) as year_month,
           count(distinct transaction_id) as total_transactions, cast(sum(quantity) as bigint) as total_quantity,
           {sql_money('sum(net_amount)')} as total_amount, {sql_money('sum(discount_amount)')} as total_discount,
           {sql_ratio('sum(net_amount)', 'count(net_amount)')} as avg_transaction_value, month_start_date, month_end_date
    from dated_sales group by customer_key, year_number, month_number, month_start_date, month_end_date""")
define("agg_product_daily", f"""
    select f.product_key, f.transaction_date_key as date_key, cast(sum(quantity) as bigint) as units_sold,
           {sql_money('sum(net_amount)')} as total_revenue, {sql_money('sum(quantity * unit_cost)')} as total_cost,
           {sql_money('sum(net_amount - quantity * unit_cost)')} as total_profit,
           count(distinct customer_key) as unique_customers
    from fact_transactions f join dim_product p on f.product_key = p.product_key
    group by f.product_key, f.transaction_date_key""")


@query("F08_agg_customer_monthly", "select * from agg_customer_monthly")
def _(c: Context) -> DataFrame:
    return facts.customer_monthly(c["fact_transactions"])


@query("F09_agg_product_daily", "select * from agg_product_daily")
def _(c: Context) -> DataFrame:
    return facts.product_daily(c["fact_transactions"], c["dim_product"])


def _loaded_in_thirds(c: Context) -> TableStore:
    """A warehouse whose orders came in three loads and one repeated load, with upkeep after each; built once."""
    store = TableStore(c.spark, f"{c.root}/thirds")
    c.once("thirds", lambda: _load_thirds(c, store))
    return store


def _load_thirds(c: Context, store: TableStore) -> None:
    store.replace(c.dim("dim_customer"), "dim_customer")
    store.replace(c.dim("dim_product"), "dim_product")
    orders, items = c.stg("stg_ecom_transactions"), c.stg("stg_ecom_transaction_items")
    number = F.substring("transaction_id", 4, 20).cast("bigint")
    for load in (F.month("transaction_date") < 5, number % 3 == 0, F.lit(True), number % 2 == 0):
        warehouse.load_transactions(store, orders.filter(load), items)
        warehouse.build_aggregates(store)
        warehouse.refresh_metrics(store)


@query("F08_incremental_months", "select * from agg_customer_monthly")
def _(c: Context) -> DataFrame:
    return _loaded_in_thirds(c).read("agg_customer_monthly")


@query("F09_incremental_days", "select * from agg_product_daily")
def _(c: Context) -> DataFrame:
    return _loaded_in_thirds(c).read("agg_product_daily")


@query("D14_folded_metrics", "select customer_key, customer_id, total_orders, total_spent, lifetime_value, is_current from dim_customer")
def _(c: Context) -> DataFrame:
    return _loaded_in_thirds(c).read("dim_customer").select(
        "customer_key", "customer_id", "total_orders", "total_spent", "lifetime_value", "is_current")


@query("F10_all_facts", """
    select 'transactions' as fact, count(*) as loaded from fact_initial
    union all
    select 'campaign_responses', count(*) from stg_campaign_responses r join customers_initial c
      on r.customer_id = c.customer_id and r.response_date >= c.valid_from and r.response_date < c.valid_to""")
def _(c: Context) -> DataFrame:
    store = TableStore(c.spark, c.scratch("facts"))
    store.replace(c.first_load(), "dim_customer")
    for name in ("dim_product", "dim_campaign"):
        store.replace(c.dim(name), name)
    counts = warehouse.load_facts(store, c.staged())
    return c.spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "fact string, loaded bigint")


@query("F11_standard_measures", f"""
    select payment_method, {sql_money('sum(net_amount)')} as total_revenue, cast(sum(quantity) as bigint) as total_units_sold,
           {sql_ratio('sum(net_amount)', 'count(net_amount)')} as average_order_value,
           {sql_money('sum(discount_amount)')} as total_discounts,
           {sql_percent('sum(discount_amount)', 'sum(line_total)', None)} as discount_percentage,
           count(distinct transaction_id) as transaction_count, count(*) as line_item_count
    from fact_transactions group by payment_method""")
def _(c: Context) -> DataFrame:
    return facts.measures(c["fact_transactions"], ["payment_method"])


# --- whole loads and validation -------------------------------------------------------------

define("customers_whole", """
    select row_number() over (order by customer_id) as customer_key, *, registration_date as valid_from,
           date '9999-12-31' as valid_to, true as is_current
    from whole_snapshot""")
define("fact_whole", _fact_sql("customers_whole"))


@query("V01_full_load", f"""
    select count(*) as lines, count(distinct transaction_id) as transactions, {sql_money('sum(net_amount)')} as net,
           count(distinct customer_key) as buyers,
           (select count(*) from customers_whole) as customers,
           {sql_money('sum(net_amount)')} as lifetime_total,
           {sql_money('sum(net_amount)')} as monthly_total, {sql_money('sum(net_amount)')} as daily_total
    from fact_whole""")
def _(c: Context) -> DataFrame:
    store = TableStore(c.spark, c.scratch("full"))
    tables, _counts, _seconds = warehouse.full_load(store, c.staged(), FIRST_LOAD)
    again, _counts, _seconds = warehouse.full_load(store, c.staged(), FIRST_LOAD)
    lifetime = tables["dim_customer"].agg(decimal_sum("lifetime_value")).scalar()
    return again["fact_transactions"].agg(
        row_count().alias("lines"), F.count_distinct("transaction_id").alias("transactions"),
        decimal_sum("net_amount").alias("net"), F.count_distinct("customer_key").alias("buyers"),
    ).withColumns(
        {
            "customers": again["dim_customer"].agg(row_count()).scalar(),
            "lifetime_total": lifetime,
            "monthly_total": again["agg_customer_monthly"].agg(decimal_sum("total_amount")).scalar(),
            "daily_total": again["agg_product_daily"].agg(decimal_sum("total_revenue")).scalar(),
        }
    )


@query("V02_row_counts", " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count from {t}" for t in validation.COUNTED))
def _(c: Context) -> DataFrame:
    return validation.row_counts(c.tables)


define("fact_damaged", """
    select * replace (case when transaction_key % 100 = 0 then -customer_key else customer_key end as customer_key,
                      case when transaction_key % 250 = 0 then null else product_key end as product_key,
                      case when transaction_key % 500 = 0 then 19000101 else transaction_date_key end as transaction_date_key)
    from fact_transactions""")


def damaged(c: Context) -> Mapping[str, DataFrame]:
    """The warehouse with planted orphans in the transaction fact."""
    fact, key = c["fact_transactions"], F.col("transaction_key")
    broken = fact.withColumns(
        {
            "customer_key": F.when(key % 100 == 0, -F.col("customer_key")).otherwise(F.col("customer_key")),
            "product_key": F.when(key % 250 != 0, F.col("product_key")),
            "transaction_date_key": F.when(key % 500 == 0, F.lit(19000101)).otherwise(F.col("transaction_date_key")),
        }
    )
    return ChainMap({"fact_transactions": broken}, c.tables)


def _orphan_sql(fact: str, column: str, dim: str, key: str, keep_null: bool = True) -> str:
    present = "" if keep_null else f" and f.{column} is not null"
    return f"""(select count(*) from {fact} f where not exists
               (select 1 from {dim} d where d.{key} = f.{column}){present})"""


def _fact_view(name: str) -> str:
    return "fact_damaged" if name == "fact_transactions" else name


@query("V03_referential_integrity", " union all ".join(
    f"select '{f}' as fact_table, '{k}' as fk_column, '{d}' as dim_table, {_orphan_sql(_fact_view(f), k, d, dk)} as orphan_count"
    for f, k, d, dk in validation.REFERENCES))
def _(c: Context) -> DataFrame:
    return validation.integrity_report(damaged(c)).drop("records")


def _constraint_sql() -> str:
    parts = []
    for table, rules in schemas.CONSTRAINTS.items():
        view = _fact_view(table)
        parts += [f"""select '{table}' as table_name, 'unique' as constraint_type, '{','.join(key)}' as columns,
            (select count(*) from (select 1 from {view} group by {', '.join(key)} having count(*) > 1)) as violations"""
                  for key in rules["unique"]]
        parts += [f"select '{table}', 'not_null', '{x}', (select count(*) from {view} where {x} is null)"
                  for x in rules["not_null"]]
        parts += [f"select '{table}', 'foreign_key', '{x}', {_orphan_sql(view, x, d, k, False)}"
                  for x, d, k in rules["references"]]
    return " union all ".join(parts)


@query("V04_constraints", _constraint_sql())
def _(c: Context) -> DataFrame:
    return validation.constraint_report(damaged(c))


@query("V05_join_coverage", """
    select 'staged_transactions' as metric, cast(count(*) as varchar) as value from stg_ecom_transactions
    union all select 'staged_items', cast(count(*) as varchar) from stg_ecom_transaction_items
    union all select 'customer_versions', cast(count(*) as varchar) from customers_merged
    union all select 'products', cast(count(*) as varchar) from dim_product
    union all select 'first_transaction_date', cast(min(transaction_date) as varchar) from stg_ecom_transactions
    union all select 'last_transaction_date', cast(max(transaction_date) as varchar) from stg_ecom_transactions
    union all select 'first_staged_customer_id', min(customer_id) from stg_ecom_transactions
    union all select 'first_dimension_customer_id', min(customer_id) from customers_merged
    union all select 'first_staged_product_id', min(product_id) from stg_ecom_transaction_items
    union all select 'first_dimension_product_id', min(product_id) from dim_product
    union all select 'transactions_matching_current_customer', cast(count(*) as varchar)
        from stg_ecom_transactions t join customers_merged c on t.customer_id = c.customer_id and c.is_current
    union all select 'transactions_matching_valid_version', cast(count(*) as varchar)
        from stg_ecom_transactions t join customers_merged c on t.customer_id = c.customer_id
        and t.transaction_date >= c.valid_from and t.transaction_date < c.valid_to
    union all select 'example_transaction', min(t.transaction_id)
        from stg_ecom_transactions t join customers_merged c on t.customer_id = c.customer_id
        and t.transaction_date >= c.valid_from and t.transaction_date < c.valid_to""")
def _(c: Context) -> DataFrame:
    return validation.join_coverage(*_sources(c))


@query("C06_text_width", " union all ".join(
    f"select '{t}' as table_name, '{x}' as column_name, {w} as declared_width, cast(coalesce(max(length({x})), 0) as int) as longest, "
    f"count(*) filter (where length({x}) > {w}) as violations from {t}"
    for t, widths in schemas.TEXT_WIDTHS.items() for x, w in widths.items()))
def _(c: Context) -> DataFrame:
    return reduce(DataFrame.union, [validation.overlong_text(c[t], t) for t in schemas.TEXT_WIDTHS])
