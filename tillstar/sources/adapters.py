"""Staging views over the generic test tables.

The SQL below uses only syntax shared by Spark and DuckDB, so that a job and the SQL it is
checked against start from identical rows. ``{name}`` stands for a source table or an
earlier view. ``load_day`` becomes the load timestamp and load id of the staging contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import row_hash


def _id(prefix: str, key: str, width: int = 8) -> str:
    text = f"cast({key} as varchar(20))"
    return f"concat('{prefix}', lpad({text}, cast(greatest({width}, length({text})) as int), '0'))"


_CUSTOMER_COLUMNS = ", ".join(schemas.SOURCE["stg_crm_customers"].names)

VIEWS: dict[str, str] = {
    "base_customers": f"""
        select c.c_custkey as custkey,
               {_id('CUST', 'c.c_custkey')} as customer_id,
               split_part(c.c_name, '#', 1) as first_name,
               split_part(c.c_name, '#', 2) as last_name,
               case when c.c_custkey % 20 = 0 then null
                    when c.c_custkey % 50 = 1 then 'bad-email'
                    else concat('user', cast(c.c_custkey as varchar(20)), '@example.com') end as email,
               case when c.c_custkey % 4 = 0 then null else {_id('555-', 'c.c_custkey', 7)} end as phone_number,
               date '1930-01-01' + cast((c.c_custkey * 37) % 25000 as int) as date_of_birth,
               case c.c_custkey % 3 when 0 then 'F' when 1 then 'M' else null end as gender,
               concat(cast(c.c_nationkey as varchar(20)), ' Main St') as address,
               n.n_name as city,
               r.r_name as state,
               lpad(cast(c.c_nationkey as varchar(20)), 5, '0') as postal_code,
               'USA' as country,
               date '1995-01-01' + cast((c.c_custkey * 13) % 1500 as int) as registration_date,
               c.c_mktsegment as customer_segment,
               case c.c_custkey % 5 when 3 then 'Inactive' when 4 then 'Suspended' else 'Active' end as account_status
        from {{customer}} c
        join {{nation}} n on c.c_nationkey = n.n_nationkey
        join {{region}} r on n.n_regionkey = r.r_regionkey""",
    # every customer, plus an older copy of each hundredth one
    "stg_crm_customers": f"""
        select {_CUSTOMER_COLUMNS}, date '2001-07-01' as load_day from {{base_customers}}
        union all
        select {_CUSTOMER_COLUMNS.replace('city', "'OLD' as city")}, date '2001-06-01' as load_day
        from {{base_customers}} where custkey % 100 = 0""",
    # first snapshot: some customers are not known yet
    "stg_customers_first": f"""
        select {_CUSTOMER_COLUMNS}, date '2001-07-01' as load_day from {{base_customers}} where custkey % 50 <> 7
        union all
        select {_CUSTOMER_COLUMNS.replace('city', "'OLD' as city")}, date '2001-06-01' as load_day
        from {{base_customers}} where custkey % 100 = 0""",
    # second snapshot: some moved, some have a new phone, the missing ones arrive
    "stg_customers_second": f"""
        select {_CUSTOMER_COLUMNS
                .replace('city', "case when custkey % 10 = 1 then 'MOVED' else city end as city")
                .replace('phone_number', "case when custkey % 10 = 2 then " + _id('777-', 'custkey', 7)
                         + " else phone_number end as phone_number")},
               date '2001-08-01' as load_day
        from {{base_customers}}""",
    "stg_products": f"""
        select {_id('PROD', 'p_partkey')} as product_id,
               p_name as product_name,
               p_type as product_category,
               concat('size', cast(p_size % 5 as varchar(20))) as product_subcategory,
               p_brand as brand,
               cast(cast(p_retailprice as decimal(10,2)) * cast(0.60 as decimal(3,2)) as decimal(10,2)) as unit_cost,
               cast(p_retailprice as decimal(10,2)) as retail_price,
               case when p_partkey % 4 = 3 then 'Discontinued' else 'Active' end as product_status,
               date '2001-07-01' as load_day
        from {{part}}""",
    # a later price list: every tenth product costs more and every third is left out
    "stg_products_second": """
        select product_id, product_name, product_category, product_subcategory, brand, unit_cost,
               case when substring(product_id, length(product_id), 1) = '1'
                    then cast(retail_price + 50 as decimal(10,2)) else retail_price end as retail_price,
               product_status, date '2001-08-01' as load_day
        from {stg_products}
        where cast(substring(product_id, 5, 20) as bigint) % 3 <> 2""",
    "stg_ecom_transactions": f"""
        select {_id('TXN', 'o_orderkey')} as transaction_id,
               {_id('CUST', 'o_custkey')} as customer_id,
               cast(o_orderdate as date) as transaction_date,
               {_id('ORD', 'o_orderkey')} as order_number,
               o_orderpriority as payment_method,
               case o_orderstatus when 'F' then 'Completed' when 'O' then 'Pending' else 'Failed' end as payment_status,
               cast(o_totalprice as decimal(12,2)) as total_amount,
               cast(0 as decimal(10,2)) as tax_amount,
               cast(0 as decimal(10,2)) as shipping_amount,
               cast(0 as decimal(10,2)) as discount_amount,
               'USD' as currency_code,
               date '2001-07-01' as load_day
        from {{orders}}""",
    "priced_lines": """
        select l.l_orderkey, l.l_partkey, p.p_name, l.l_linenumber,
               cast(l.l_quantity as int) as quantity,
               cast(p.p_retailprice as decimal(10,2)) as unit_price,
               cast(l.l_discount as decimal(4,2)) as discount_rate
        from {lineitem} l join {part} p on l.l_partkey = p.p_partkey""",
    "discounted_lines": """
        select *, case when l_linenumber % 5 = 0
                       then cast(quantity * unit_price * discount_rate as decimal(12,2))
                       else cast(0 as decimal(12,2)) end as discount_amount
        from {priced_lines}""",
    "stg_ecom_transaction_items": f"""
        select cast(null as varchar(20)) as transaction_item_id,
               {_id('TXN', 'l_orderkey')} as transaction_id,
               {_id('PROD', 'l_partkey')} as product_id,
               p_name as product_name,
               quantity,
               unit_price,
               cast(quantity * unit_price - discount_amount as decimal(12,2)) as line_total,
               discount_amount,
               date '2001-07-01' as load_day
        from {{discounted_lines}}""",
    "stg_marketing_campaigns": f"""
        select {_id('CAMP', 'n_nationkey', 4)} as campaign_id,
               n_name as campaign_name,
               case n_regionkey when 0 then 'Seasonal' when 1 then 'Promotional' when 2 then 'Loyalty'
                                when 3 then 'Clearance' else 'Launch' end as campaign_type,
               case n_nationkey % 4 when 0 then 'Email' when 1 then 'Social Media' when 2 then 'Display Ads'
                                    else 'Search Ads' end as channel,
               date '2024-01-01' + cast(n_nationkey % 5 as int) as start_date,
               date '2024-01-08' + cast(n_nationkey % 20 as int) as end_date,
               cast(1000 + n_nationkey * 100 as decimal(12,2)) as budget,
               'All' as target_audience,
               case n_nationkey % 4 when 2 then 'Active' when 3 then 'Planned' else 'Completed' end as campaign_status,
               date '2024-01-01' as load_day
        from {{nation}}""",
    "stg_campaign_responses": f"""
        select {_id('RESP', 'event_id')} as response_id,
               {_id('CAMP', 'event_id % 25', 4)} as campaign_id,
               {_id('CUST', 'user_id')} as customer_id,
               cast(ts as date) as response_date,
               case event_type when 'view' then 'opened' when 'click' then 'clicked' else 'converted' end
                   as response_type,
               case when event_type = 'purchase' then cast(value as decimal(10,2))
                    else cast(0 as decimal(10,2)) end as conversion_value,
               date '2024-01-31' as load_day
        from {{events}}
        where event_type in ('view', 'click', 'purchase')""",
}

_VIEW_SCHEMA = {
    "stg_customers_first": "stg_crm_customers",
    "stg_customers_second": "stg_crm_customers",
    "stg_products_second": "stg_products",
}


def inputs_of(text: str) -> list[str]:
    """Names of the tables and views a view's SQL refers to."""
    import re

    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The raw rows of one view over the tables in ``folder``."""
    if name not in VIEWS:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    text = VIEWS[name]
    return spark.sql(text, **{n: view(spark, folder, n) for n in inputs_of(text)})


def staged(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One view in its staging contract, audit columns included."""
    base = _VIEW_SCHEMA.get(name, name)
    source = schemas.SOURCE[base].names
    rows = view(spark, folder, name)
    audited = rows.withColumns(
        {
            "source_file": F.concat(F.lit(f"{base.removeprefix('stg_')}_"), F.date_format("load_day", "yyyyMMdd"), F.lit(".csv")),
            "load_timestamp": F.col("load_day").cast("timestamp_ntz"),
            "row_hash": row_hash(source),
            "load_id": F.date_format("load_day", "yyyyMMdd").cast("bigint") * 1000000,
        }
    )
    return audited.select(*[F.col(f.name).cast(f.dataType) for f in schemas.STAGING[base]])
