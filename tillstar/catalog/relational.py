"""Projections, filters, joins, aggregation, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.catalog.base import (
    SECOND_LOAD, Context, query, sql_money, sql_percent, sql_ratio,
)
from tillstar.functions import decimal_sum, mean, ratio, row_count
from tillstar.operators import aggregates, rows
from tillstar.operators.keys import stored_once
from tillstar.operators.lookup import lookup, lookup_scd2
from tillstar.operators.pairs import name_pairs
from tillstar.sources.tables import TableStore
from tillstar.plans import dimensions, facts

# --- projections and filters ----------------------------------------------------------------

_FACT = [n for n in schemas.WAREHOUSE["fact_transactions"].names if n != "source_system"]


@query("P01_projection", f"select {', '.join(_FACT)} from fact_transactions")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].select(*_FACT)


@query("P02_not_null_key", """
    select transaction_id, product_id, quantity
    from (select transaction_id, quantity, case when quantity % 7 = 0 then null else product_id end as product_id
          from stg_ecom_transaction_items) q
    where transaction_id is not null and product_id is not null""")
def _(c: Context) -> DataFrame:
    # some keys are missing
    items = c.stg("stg_ecom_transaction_items").withColumn(
        "product_id", F.when(F.col("quantity") % 7 == 0, F.lit(None)).otherwise(F.col("product_id")))
    present = items.filter(F.col("transaction_id").isNotNull() & F.col("product_id").isNotNull())
    return present.select("transaction_id", "product_id", "quantity")


@query("P03_flag_filter", """
    select customer_key, customer_id, email from dim_customer where is_current and account_status = 'Active'""")
def _(c: Context) -> DataFrame:
    kept = c["dim_customer"].filter(F.col("is_current") & (F.col("account_status") == "Active"))
    return kept.select("customer_key", "customer_id", "email")


@query("P04_range_filter", """
    select customer_key, age, is_current from dim_customer where (age < 18) or (age > 60 and is_current)""")
def _(c: Context) -> DataFrame:
    age = F.col("age")
    return c["dim_customer"].filter((age < 18) | ((age > 60) & F.col("is_current"))).select(
        "customer_key", "age", "is_current"
    )


@query("P05_in_list", """
    select date_key, day_name, day_of_week in (0, 6) as weekend from dim_date
    where day_of_week in (0, 6) and month_number not in (6, 7, 8)
      and date_key in (select transaction_date_key from fact_transactions)""")
def _(c: Context) -> DataFrame:
    used = rows.already_in(
        c["dim_date"], c["fact_transactions"].select(F.col("transaction_date_key").alias("date_key")), ["date_key"],
        repeated=True,
    )
    dow = F.col("day_of_week")
    return used.filter(dow.isin(0, 6) & ~F.col("month_number").isin(6, 7, 8)).select(
        "date_key", "day_name", dow.isin(0, 6).alias("weekend")
    )


EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


@query("P06_regex_mismatch", f"""
    select customer_key, email from dim_customer where email is not null and not regexp_matches(email, '{EMAIL}')""")
def _(c: Context) -> DataFrame:
    email = F.col("email")
    return c["dim_customer"].filter(email.isNotNull() & ~email.rlike(EMAIL)).select("customer_key", "email")


@query("P07_scalar_subquery", """
    select transaction_key, transaction_id, net_amount from fact_transactions
    where transaction_date_key = (select max(transaction_date_key) from fact_transactions)""")
def _(c: Context) -> DataFrame:
    fact = c["fact_transactions"]
    last = fact.agg(F.max("transaction_date_key")).scalar()
    return fact.filter(F.col("transaction_date_key") == last).select("transaction_key", "transaction_id", "net_amount")


@query("P08_null_safe_change", """
    select s.customer_id from second_snapshot s join customers_initial c on s.customer_id = c.customer_id
    where s.city is distinct from c.city or s.email is distinct from c.email
       or s.phone_number is distinct from c.phone_number""")
def _(c: Context) -> DataFrame:
    old = c.first_load().alias("o")
    new = dimensions.derive_customer(c.stg("stg_customers_second"), SECOND_LOAD).alias("n")
    pairs = [(F.col(f"n.{x}"), F.col(f"o.{x}")) for x in ("city", "email", "phone_number")]
    return new.join(old, F.col("n.customer_id") == F.col("o.customer_id")).filter(rows.differs(pairs)).select(
        F.col("n.customer_id").alias("customer_id")
    )


@query("P09_type_coercion", """
    select event_id, cast(user_id as int) as user_id, cast(value as decimal(10,2)) as amount,
           try_cast(event_type as int) as bad_number, try_cast(cast(event_id as varchar) as int) as good_number
    from events""")
def _(c: Context) -> DataFrame:
    events = c.spark.read.parquet(f"{c.folder}/events.parquet")
    return events.select(
        "event_id", F.col("user_id").cast("int").alias("user_id"), F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("event_type").try_cast("int").alias("bad_number"),
        F.col("event_id").cast("string").try_cast("int").alias("good_number"),
    )


@query("P10_constant_columns", """
    select product_id, 'E-COMMERCE' as source_system, date '9999-12-31' as valid_to, true as is_current
    from stg_products""")
def _(c: Context) -> DataFrame:
    return c.stg("stg_products").select("product_id").withColumns(
        {"source_system": F.lit("E-COMMERCE"), "valid_to": F.lit("9999-12-31").cast("date"), "is_current": F.lit(True)}
    )


# --- joins ----------------------------------------------------------------------------------


@query("J01_header_items", """
    select t.transaction_id, t.customer_id, i.product_id, i.quantity, i.line_total, t.payment_method
    from stg_ecom_transactions t join stg_ecom_transaction_items i on t.transaction_id = i.transaction_id""")
def _(c: Context) -> DataFrame:
    joined = facts.headers_with_items(c.stg("stg_ecom_transactions"), c.stg("stg_ecom_transaction_items"))
    return joined.select("transaction_id", "customer_id", "product_id", "quantity", "line_total", "payment_method")


def _temporal(c: Context, inclusive: bool) -> DataFrame:
    found = lookup_scd2(
        c.stg("stg_ecom_transactions"), c.dim("dim_customer"), "customer_id", "transaction_date", "customer_key",
        inclusive=inclusive,
    )
    return found.select("transaction_id", "customer_id", "customer_key")


_TEMPORAL = """
    select t.transaction_id, t.customer_id, c.customer_key from stg_ecom_transactions t
    join customers_merged c on t.customer_id = c.customer_id
     and t.transaction_date >= c.valid_from and t.transaction_date {} c.valid_to"""


@query("J02_temporal_range_join", _TEMPORAL.format("<"))
def _(c: Context) -> DataFrame:
    return _temporal(c, inclusive=False)


@query("J02_temporal_range_join_inclusive", _TEMPORAL.format("<="))
def _(c: Context) -> DataFrame:
    return _temporal(c, inclusive=True)


@query("J03_dimension_join", """
    select f.transaction_key, p.product_name, d.day_name
    from fact_transactions f join dim_product p on f.product_key = p.product_key
    join dim_date d on f.transaction_date_key = d.date_key""")
def _(c: Context) -> DataFrame:
    # one row per day: the only dimension with a proven bound
    days = F.broadcast(c["dim_date"].select(F.col("date_key").alias("transaction_date_key"), "day_name"))
    named = lookup(c["fact_transactions"], c["dim_product"], "product_key", "product_name")
    return named.join(days, "transaction_date_key").select("transaction_key", "product_name", "day_name")


@query("J04_left_outer", """
    select c.customer_key, c.customer_id, f.transaction_id, f.net_amount
    from dim_customer c left join fact_transactions f on c.customer_key = f.customer_key""")
def _(c: Context) -> DataFrame:
    return c["dim_customer"].join(c["fact_transactions"], "customer_key", "left").select(
        "customer_key", "customer_id", "transaction_id", "net_amount"
    )


@query("J05_left_outer_aggregate", """
    select c.customer_key, s.last_day, s.lines from dim_customer c
    left join (select customer_key, max(transaction_date_key) as last_day, count(*) as lines
               from fact_transactions group by customer_key) s on c.customer_key = s.customer_key""")
def _(c: Context) -> DataFrame:
    sold = c["fact_transactions"].groupBy("customer_key").agg(
        F.max("transaction_date_key").alias("last_day"), row_count().alias("lines")
    )
    return c["dim_customer"].join(sold, "customer_key", "left").select("customer_key", "last_day", "lines")


@query("J06_shifted_self_join", f"""
    select a.year_month, a.revenue, b.revenue as year_before
    from (select year_number * 100 + month_number as year_month, {sql_money('sum(net_amount)')} as revenue
          from dated_sales group by 1) a
    join (select year_number * 100 + month_number as year_month, {sql_money('sum(net_amount)')} as revenue
          from dated_sales group by 1) b on a.year_month = b.year_month + 100""")
def _(c: Context) -> DataFrame:
    month = F.floor(F.col("transaction_date_key") / 100).cast("int").alias("year_month")
    monthly = stored_once(c["fact_transactions"].groupBy(month).agg(decimal_sum("net_amount").alias("revenue")), "monthly")
    before = monthly.select((F.col("year_month") + 100).alias("year_month"), F.col("revenue").alias("year_before"))
    return monthly.join(before, "year_month").select("year_month", "revenue", "year_before")


@query("J07_pair_self_join", f"""
    select p1.product_name as product_1, p2.product_name as product_2, count(*) as line_pairs,
           count(distinct a.transaction_id) as transactions
    from fact_transactions a
    join fact_transactions b on a.transaction_id = b.transaction_id and a.product_key < b.product_key
    join dim_product p1 on a.product_key = p1.product_key join dim_product p2 on b.product_key = p2.product_key
    group by 1, 2""")
def _(c: Context) -> DataFrame:
    return name_pairs(c["fact_transactions"], c["dim_product"], min_transactions=1, slice_size=4).select(
        "product_1", "product_2", "line_pairs", F.col("times_bought_together").alias("transactions")
    )


@query("J08_not_exists", """
    select customer_key, customer_id from dim_customer c
    where not exists (select 1 from fact_transactions f where f.customer_key = c.customer_key)""")
def _(c: Context) -> DataFrame:
    return rows.not_yet_in(c["dim_customer"], c["fact_transactions"], ["customer_key"], repeated=True).select(
        "customer_key", "customer_id"
    )


@query("J09_not_in_existing", """
    select product_id, retail_price from stg_products
    where product_id not in (select product_id from stg_products_second)""")
def _(c: Context) -> DataFrame:
    return rows.not_yet_in(c.stg("stg_products"), c.stg("stg_products_second"), ["product_id"]).select(
        "product_id", "retail_price"
    )


@query("J10_in_existing", """
    select product_id, retail_price from stg_products
    where product_id in (select product_id from stg_products_second)""")
def _(c: Context) -> DataFrame:
    return rows.already_in(c.stg("stg_products"), c.stg("stg_products_second"), ["product_id"]).select(
        "product_id", "retail_price"
    )


@query("J11_update_from_join", f"""
    select p.product_key, p.product_id, coalesce(s.units, 0) as units_sold, {sql_money('coalesce(s.revenue, 0)')} as revenue
    from dim_product p left join (select product_key, cast(sum(quantity) as bigint) as units, sum(net_amount) as revenue
                                  from fact_transactions group by product_key) s on p.product_key = s.product_key""")
def _(c: Context) -> DataFrame:
    sold = c["fact_transactions"].groupBy("product_key").agg(
        F.sum("quantity").alias("units"), decimal_sum("net_amount").alias("spent")
    )
    return c["dim_product"].join(sold, "product_key", "left").select(
        "product_key", "product_id", F.coalesce("units", F.lit(0)).alias("units_sold"),
        F.coalesce("spent", F.lit(0).cast("decimal(28,2)")).alias("revenue"),
    )


@query("J12_three_way_metadata_join", """
    select t.rule_id, r.rule_name, k.category_name, t.failed_records
    from dq_test_results t join dq_rules r on t.rule_id = r.rule_id
    join dq_rule_categories k on r.category_id = k.category_id""")
def _(c: Context) -> DataFrame:
    from tillstar.catalog.quality_queries import dq

    q = dq(c)
    return (
        q["dq_test_results"].join(q["dq_rules"], "rule_id").join(q["dq_rule_categories"], "category_id")
        .select("rule_id", "rule_name", "category_name", "failed_records")
    )


@query("J13_left_lookup_keeping_orphans", """
    select t.transaction_id, i.quantity, i.line_total, c.customer_key, p.product_key
    from stg_ecom_transactions t join stg_ecom_transaction_items i on t.transaction_id = i.transaction_id
    left join customers_merged c on t.customer_id = c.customer_id
         and t.transaction_date >= c.valid_from and t.transaction_date < c.valid_to
    left join dim_product p on i.product_id = p.product_id""")
def _(c: Context) -> DataFrame:
    # the staging is gone over once, so it need not be stored for it
    return facts.transaction_lines(
        c.passing("stg_ecom_transactions"), c.passing("stg_ecom_transaction_items"), c.dim("dim_customer"),
        c.dim("dim_product"), keep_orphans=True,
    ).select("transaction_id", "quantity", "line_total", "customer_key", "product_key")


# --- aggregation ----------------------------------------------------------------------------


@query("A01_group_aggregates", f"""
    select product_key, count(*) as lines, cast(sum(quantity) as bigint) as units,
           {sql_ratio('sum(net_amount)', 'count(net_amount)')} as avg_net, min(net_amount) as low, max(net_amount) as high
    from fact_transactions group by product_key""")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].groupBy("product_key").agg(
        row_count().alias("lines"), F.sum("quantity").alias("units"), mean("net_amount").alias("avg_net"),
        F.min("net_amount").alias("low"), F.max("net_amount").alias("high"),
    )


@query("A02_several_distinct_counts", """
    select payment_method, count(distinct transaction_id) as transactions, count(distinct customer_key) as customers,
           count(distinct product_key) as products, count(*) as lines
    from fact_transactions group by payment_method""")
def _(c: Context) -> DataFrame:
    return aggregates.group_with_distincts(
        c["fact_transactions"], ["payment_method"], {"lines": row_count()},
        {"transactions": "transaction_id", "customers": "customer_key", "products": "product_key"},
    )


@query("A02_approximate_distinct", """
    select payment_method, true as within_tenth from fact_transactions group by payment_method""")
def _(c: Context) -> DataFrame:
    counted = c["fact_transactions"].groupBy("payment_method").agg(
        F.approx_count_distinct("transaction_id", 0.02).alias("sketch"),
        F.count_distinct("transaction_id").alias("exact"),
    )
    close = F.abs(F.col("sketch") - F.col("exact")) <= 0.1 * F.col("exact")
    return counted.select("payment_method", close.alias("within_tenth"))


@query("A02_distincts_from_daily_sketches", """
    select payment_method, true as transactions, true as customers from fact_transactions
    where transaction_date_key between 19960101 and 19971231 group by payment_method""")
def _(c: Context) -> DataFrame:
    # sketches by day, stored in two loads and merged over two years of days
    fact, names = c["fact_transactions"], {"transactions": "transaction_id", "customers": "customer_key"}
    store = TableStore(c.spark, c.scratch("sketches"))
    for half in (F.col("transaction_key") % 2 == 0, F.col("transaction_key") % 2 == 1):
        store.append(aggregates.day_sketches(fact.filter(half), "transaction_date_key", ["payment_method"], names), "distincts")
    years = F.col("transaction_date_key").between(19960101, 19971231)
    near = aggregates.distincts_of(store.read("distincts").filter(years), ["payment_method"], list(names))
    exact = fact.filter(years).groupBy("payment_method").agg(*[F.count_distinct(v).alias(f"exact_{n}") for n, v in names.items()])
    return near.join(exact, "payment_method").select("payment_method", *[
        (F.abs(F.col(n) - F.col(f"exact_{n}")) <= 0.05 * F.col(f"exact_{n}")).alias(n) for n in names])


@query("A03_conditional_aggregates", f"""
    select payment_method, count(distinct case when payment_status = 'Completed' then transaction_id end) as completed,
           {sql_money("sum(case when payment_status = 'Failed' then net_amount else 0 end)")} as failed_value
    from fact_transactions group by payment_method""")
def _(c: Context) -> DataFrame:
    status = F.col("payment_status")
    return c["fact_transactions"].groupBy("payment_method").agg(
        F.count_distinct(F.when(status == "Completed", F.col("transaction_id"))).alias("completed"),
        decimal_sum(F.when(status == "Failed", F.col("net_amount")).otherwise(0)).alias("failed_value"),
    )


@query("A04_group_by_case", """
    select case when net_amount >= 30000 then 'large' when net_amount >= 10000 then 'medium' else 'small' end as size,
           count(*) as lines
    from fact_transactions group by 1""")
def _(c: Context) -> DataFrame:
    net = F.col("net_amount")
    size = F.when(net >= 30000, "large").when(net >= 10000, "medium").otherwise("small")
    return c["fact_transactions"].withColumn("size", size).groupBy("size").agg(row_count().alias("lines"))


@query("A05_having", """
    select customer_key, count(distinct transaction_id) as orders from fact_transactions
    group by customer_key having count(distinct transaction_id) > 8""")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].groupBy("customer_key").agg(
        F.count_distinct("transaction_id").alias("orders")
    ).filter("orders > 8")


@query("A06_global_having", f"""
    select max(transaction_date_key) as last_day, {sql_money('sum(net_amount)')} as revenue
    from fact_transactions having max(transaction_date_key) < 20300101""")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].agg(
        F.max("transaction_date_key").alias("last_day"), decimal_sum("net_amount").alias("revenue")
    ).filter("last_day < 20300101")


@query("A07_distinct", "select distinct product_category, product_subcategory, brand from stg_products")
def _(c: Context) -> DataFrame:
    return c.stg("stg_products").select("product_category", "product_subcategory", "brand").distinct()


@query("A08_keep_latest", """
    select customer_id, transaction_id, transaction_date from (
        select customer_id, transaction_id, transaction_date,
               row_number() over (partition by customer_id order by transaction_date desc, transaction_id) as n
        from stg_ecom_transactions) q where n = 1""")
def _(c: Context) -> DataFrame:
    orders = c.stg("stg_ecom_transactions").withColumn("transaction_date", F.to_date("transaction_date"))
    latest = rows.keep_latest(
        orders.select("customer_id", "transaction_id", "transaction_date"), ["customer_id"],
        [F.col("transaction_date").desc(), F.col("transaction_id").asc()],
    )
    return latest.select("customer_id", "transaction_id", "transaction_date")


@query("A09_pivot", """
    select payment_method, count(*) filter (where payment_status = 'Completed') as completed,
           count(*) filter (where payment_status = 'Pending') as pending,
           count(*) filter (where payment_status = 'Failed') as failed
    from stg_ecom_transactions group by payment_method""")
def _(c: Context) -> DataFrame:
    # the status list is fixed, so no extra job looks for the distinct values
    wide = c.stg("stg_ecom_transactions").groupBy("payment_method").pivot(
        "payment_status", ["Completed", "Pending", "Failed"]
    ).agg(row_count())
    return wide.select(
        "payment_method", *[F.coalesce(F.col(s), F.lit(0)).alias(s.lower()) for s in ("Completed", "Pending", "Failed")]
    )


@query("W01_share_of_total", f"""
    select payment_method, revenue, {sql_percent('revenue', 'sum(revenue) over ()')} as revenue_share
    from (select payment_method, {sql_money('sum(net_amount)')} as revenue from fact_transactions group by 1) q""")
def _(c: Context) -> DataFrame:
    grouped = c["fact_transactions"].groupBy("payment_method").agg(decimal_sum("net_amount").alias("revenue"))
    return aggregates.share_of_total(grouped, "revenue", "revenue_share")


@query("W02_latest_row", """
    select customer_key, arg_max(transaction_id, (transaction_date_key, transaction_id)) as last_transaction
    from fact_transactions group by customer_key""")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].groupBy("customer_key").agg(
        F.max_by("transaction_id", F.struct("transaction_date_key", "transaction_id")).alias("last_transaction")
    )


@query("O01_order_by", """
    select customer_id, phone_number, registration_date from dim_customer where is_current
    order by phone_number desc nulls first, customer_id""")
def _(c: Context) -> DataFrame:
    return c["dim_customer"].filter("is_current").select("customer_id", "phone_number", "registration_date").orderBy(
        F.col("phone_number").desc_nulls_first(), "customer_id"
    )


@query("O02_top_k", """
    select transaction_key, net_amount from fact_transactions order by net_amount desc, transaction_key limit 25""")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].select("transaction_key", "net_amount").orderBy(
        F.col("net_amount").desc(), "transaction_key"
    ).limit(25)


@query("O03_capped_sample", """
    select transaction_key, discount_amount from fact_transactions where discount_amount > 0
    order by transaction_key limit 1000""")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].filter("discount_amount > 0").select("transaction_key", "discount_amount").orderBy(
        "transaction_key"
    ).limit(1000)


@query("U01_union_all", """
    select customer_id as id, city as label from customers_merged where is_current
    union all select product_id, product_category from dim_product""")
def _(c: Context) -> DataFrame:
    customers = c["dim_customer"].filter("is_current").select(F.col("customer_id").alias("id"), F.col("city").alias("label"))
    return customers.union(c["dim_product"].select("product_id", "product_category"))


@query("U02_concat_by_name", """
    select customer_id, change from change_labels where change = 'new'
    union all select customer_id, change from change_labels where change = 'scd2_changed'""")
def _(c: Context) -> DataFrame:
    from tillstar.catalog.dims import _classified

    labelled = _classified(c).select("customer_id", "change")
    return labelled.filter("change = 'new'").unionByName(labelled.filter("change = 'scd2_changed'").select("change", "customer_id"))


@query("U03_upsert", """
    select product_id, retail_price from stg_products_second
    union all select product_id, retail_price from stg_products
    where product_id not in (select product_id from stg_products_second)""")
def _(c: Context) -> DataFrame:
    pair = ["product_id", "retail_price"]
    return rows.upsert(c.stg("stg_products").select(*pair), c.stg("stg_products_second").select(*pair), ["product_id"])


@query("U03_insert_missing", "select product_id, retail_price from stg_products")
def _(c: Context) -> DataFrame:
    # every product is known to the full list, so the changed prices of the second are ignored
    pair = ["product_id", "retail_price"]
    third = F.substring("product_id", 5, 20).cast("bigint") % 3 == 2
    known = c.stg("stg_products").select(*pair)
    return rows.insert_missing(
        rows.insert_missing(known.filter(third), known, ["product_id"]), c.stg("stg_products_second").select(*pair),
        ["product_id"],
    )


@query("G01_common_table", f"""
    select transaction_date_key // 100 as transaction_month, {sql_money('sum(net_amount)')} as revenue,
           cast(sum(net_amount) as double) > (select cast(sum(net_amount) as double) / count(distinct transaction_date_key // 100)
                                              from fact_transactions) as above_average
    from fact_transactions group by 1""")
def _(c: Context) -> DataFrame:
    month = F.floor(F.col("transaction_date_key") / 100).cast("int").alias("transaction_month")
    monthly = c["fact_transactions"].groupBy(month).agg(decimal_sum("net_amount").alias("revenue"))
    monthly = stored_once(monthly, "monthly")
    average = monthly.agg(mean("revenue")).scalar()
    return monthly.withColumn("above_average", ratio("revenue", average) > 1)


