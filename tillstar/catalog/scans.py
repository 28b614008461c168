"""Scans, sources, sinks and table metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.catalog.base import Context, query, sql_percent, sql_ratio
from tillstar.sources import adapters, files, profile
from tillstar.sources.tables import TableStore

SOURCE_VIEWS = {name: name for name in schemas.SOURCE}
LOAD_TIME = dt.datetime(2001, 8, 1, 6, 30, 0)
LOAD_ID = files.load_id_of(LOAD_TIME)


def csv_folder(c: Context) -> str:
    """The six sources as CSV, an older and a newer customer file among them."""
    folder = f"{c.root}/csv"

    def write() -> None:
        def put(name: str, df: DataFrame, stamp: str) -> None:
            target = schemas.SOURCE_GLOB[name].replace("*", stamp)
            df.select(*schemas.SOURCE[name].names).write.mode("overwrite").option("header", True).csv(f"{folder}/{target}")

        put("stg_crm_customers", adapters.staged(c.spark, c.folder, "stg_customers_first"), "20010701")
        for name in schemas.SOURCE:
            put(name, adapters.staged(c.spark, c.folder, name), "20010801")

    c.once("csv", write)
    return folder


def _csv(c: Context, name: str) -> DataFrame:
    path = files.latest_file(c.spark, csv_folder(c), schemas.SOURCE_GLOB[name])
    return files.read_source(c.spark, name, path).drop(files.CORRUPT)


_READABLE = {
    "stg_crm_customers": "customer_id, first_name, last_name, email, phone_number, date_of_birth, gender, address, city, "
    "state, postal_code, country, registration_date, customer_segment, account_status",
    "stg_products": "product_id, product_name, product_category, product_subcategory, brand, unit_cost, retail_price, "
    "product_status",
    "stg_ecom_transactions": "transaction_id, customer_id, cast(transaction_date as date) as transaction_date, "
    "order_number, payment_method, payment_status, tax_amount, shipping_amount, currency_code",
    "stg_ecom_transaction_items": "transaction_id, product_id, product_name, quantity, unit_price, line_total, "
    "discount_amount",
    "stg_marketing_campaigns": "campaign_id, campaign_name, campaign_type, channel, start_date, end_date, budget, "
    "target_audience, campaign_status",
    "stg_campaign_responses": "response_id, campaign_id, customer_id, response_date, response_type, conversion_value",
}


def _register_scan(name: str) -> None:
    @query(f"S01_csv_scan_{name.removeprefix('stg_')}", f"select {_READABLE[name]} from {name}")
    def _(c: Context) -> DataFrame:
        return _csv(c, name).selectExpr(*_READABLE[name].split(", "))


for _source in schemas.SOURCE:
    _register_scan(_source)


@query("S02_latest_file", """
    select 'crm_customers_20010801.csv' as file_name, count(*) as row_count from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    path = files.latest_file(c.spark, csv_folder(c), schemas.SOURCE_GLOB["stg_crm_customers"])
    rows = files.read_source(c.spark, "stg_crm_customers", path)
    return rows.agg(F.lit(path.rsplit("/", 1)[-1]).alias("file_name"), F.count("customer_id").alias("row_count"))


@query("S03_audit_columns", f"""
    select campaign_id, 'marketing_campaigns_20010801.csv' as source_file,
           '2001-08-01 06:30:00' as load_timestamp, cast({LOAD_ID} as bigint) as load_id
    from stg_marketing_campaigns""")
def _(c: Context) -> DataFrame:
    rows = files.with_audit(_csv(c, "stg_marketing_campaigns"), "marketing_campaigns_20010801.csv", LOAD_ID, LOAD_TIME)
    return rows.select("campaign_id", "source_file", F.col("load_timestamp").cast("string"), "load_id")


_HASHED = "response_id, campaign_id, customer_id, response_date, response_type, conversion_value"


@query("S04_row_hash", f"""
    select response_id, md5(concat_ws('|', {', '.join(f"coalesce(cast({x} as varchar), '<null>')" for x in _HASHED.split(', '))}))
           as row_hash
    from stg_campaign_responses""")
def _(c: Context) -> DataFrame:
    rows = adapters.view(c.spark, c.folder, "stg_campaign_responses")
    return files.with_row_hash(rows, _HASHED.split(", ")).select("response_id", "row_hash")


@query("S04_row_hash_with_nulls", """
    select customer_id, md5(concat_ws('|', customer_id, coalesce(email, '<null>'), coalesce(phone_number, '<null>'))) as row_hash
    from stg_crm_customers""")
def _(c: Context) -> DataFrame:
    rows = adapters.view(c.spark, c.folder, "stg_crm_customers")
    return files.with_row_hash(rows, ["customer_id", "email", "phone_number"]).select("customer_id", "row_hash")


@query("S05_append", """
    select payment_status, 2 * count(*) as row_count, 2 * count(*) as appended
    from stg_ecom_transactions group by payment_status""")
def _(c: Context) -> DataFrame:
    store = TableStore(c.spark, c.scratch("append"))
    rows = adapters.staged(c.spark, c.folder, "stg_ecom_transactions").select("transaction_id", "payment_status")
    reported = store.append(rows, "copy") + store.append(rows, "copy")
    total = store.read("copy").groupBy("payment_status").agg(F.count(F.lit(1)).alias("row_count"))
    share = F.col("row_count") * F.lit(reported) / F.lit(store.count("copy"))
    return total.withColumn("appended", share.cast("bigint"))


def _loaded(c: Context) -> tuple[TableStore, dict[str, int]]:
    store = TableStore(c.spark, c.scratch("load"))
    return store, files.load_all(store, csv_folder(c), now=LOAD_TIME)


@query("S06_load_audit", f"""
    select cast({LOAD_ID} as bigint) as load_id, table_name, 'FULL' as load_type, rows_loaded,
           cast(0 as bigint) as rows_rejected, 'SUCCESS' as load_status, 'system' as loaded_by, true as timed
    from ({" union all ".join(f"select '{n}' as table_name, count(*) as rows_loaded from {n}" for n in schemas.SOURCE)}) t""")
def _(c: Context) -> DataFrame:
    store, _counts = _loaded(c)
    timed = (F.col("load_end_time") >= F.col("load_start_time")).alias("timed")
    return store.read("stg_audit_log").select(
        "load_id", "table_name", "load_type", "rows_loaded", "rows_rejected", "load_status", "loaded_by", timed
    )


@query("S07_load_all", " union all ".join(
    f"select '{n}' as table_name, count(*) as row_count, count(*) as reported from {n}" for n in schemas.SOURCE))
def _(c: Context) -> DataFrame:
    store, counts = _loaded(c)
    parts = [
        store.read(n).agg(F.lit(n).alias("table_name"), F.count("row_hash").alias("row_count"),
                          F.lit(counts[n]).cast("bigint").alias("reported"))
        for n in schemas.SOURCE
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query("S08_parameterised_query", """
    select customer_segment, count(*) as customers from customers_merged
    where is_current and state = 'REGION_1' or is_current and city = 'MOVED'
    group by customer_segment""")
def _(c: Context) -> DataFrame:
    c.dim("dim_customer")  # the query needs no sales
    return c.store.sql(
        "select customer_segment, count(*) as customers from {customers} "
        "where is_current and (state = :state or city = :city) group by customer_segment",
        {"state": "REGION_1", "city": "MOVED"},
        customers="dim_customer",
    )


@query("S08_full_scan", "select campaign_key, campaign_id, campaign_name, budget from dim_campaign")
def _(c: Context) -> DataFrame:
    return c["dim_campaign"].select("campaign_key", "campaign_id", "campaign_name", "budget")


@query("S09_row_count", "select count(*) as row_count from fact_transactions")
def _(c: Context) -> DataFrame:
    return c["fact_transactions"].agg(F.count(F.lit(1)).alias("row_count"))


@query("S10_compacted_appends", "select response_id, response_type from stg_campaign_responses")
def _(c: Context) -> DataFrame:
    store = TableStore(c.spark, c.scratch("appends"))
    rows = adapters.staged(c.spark, c.folder, "stg_campaign_responses").select("response_id", "response_type")
    for part in range(8):
        store.append(rows.filter(F.pmod(F.hash("response_id"), F.lit(8)) == part), "copy")
    store.compact("copy", sort_by=["response_id"])
    store.expire("copy", keep=1)
    return store.read("copy")


@query("S10_replace", "select response_type, count(*) as row_count from stg_campaign_responses group by response_type")
def _(c: Context) -> DataFrame:
    store = TableStore(c.spark, c.scratch("replace"))
    rows = adapters.staged(c.spark, c.folder, "stg_campaign_responses").select("response_id", "response_type")
    store.replace(rows, "copy")
    store.append(rows, "copy")
    # rebuilt from the table itself while it is being read
    store.replace(store.read("copy").distinct(), "copy")
    return store.read("copy").groupBy("response_type").agg(F.count(F.lit(1)).alias("row_count"))


def _profile_sql(view: str, columns: dict[str, str]) -> str:
    """Profile of a view; ``columns`` maps a column to its type name."""
    parts = []
    for name, kind in columns.items():
        number = kind.startswith("decimal") or kind in ("int", "bigint")
        avg = sql_ratio(f"sum({name})", f"count({name})") if number else "cast(null as double)"
        parts.append(f"""
            select '{view}' as table_name, '{name}' as column_name, '{kind}' as data_type, count(*) as total_rows,
                   count(*) - count({name}) as null_count,
                   {sql_percent(f'count(*) - count({name})', 'count(*)')} as null_percentage,
                   count(distinct {name}) as distinct_count, cast(min({name}) as varchar) as min_value,
                   cast(max({name}) as varchar) as max_value, {avg} as avg_value,
                   (select cast({name} as varchar) from {view} where {name} is not null
                    group by {name} order by count(*) desc, cast({name} as varchar) limit 1) as most_frequent_value
            from {view}""")
    return " union all ".join(parts)


_ITEM_COLUMNS, _CUSTOMER_PROFILE = (
    {f.name: f.dataType.simpleString() for f in schemas.SOURCE[name]}
    for name in ("stg_ecom_transaction_items", "stg_crm_customers"))


@query("S11_column_profile", _profile_sql("stg_ecom_transaction_items", _ITEM_COLUMNS) + " union all "
       + _profile_sql("stg_crm_customers", _CUSTOMER_PROFILE))
def _(c: Context) -> DataFrame:
    items = profile.profile(
        c.stg("stg_ecom_transaction_items").select(*_ITEM_COLUMNS), "stg_ecom_transaction_items", LOAD_TIME.date()
    )
    customers = profile.profile(
        c.stg("stg_crm_customers").select(*_CUSTOMER_PROFILE), "stg_crm_customers", LOAD_TIME.date()
    )
    return items.union(customers).drop("profile_date")


@query("S12_table_columns", " union all ".join(
    f"select '{t}' as table_name, {i} as position, '{n}' as column_name, count(*) as row_count from {t}"
    for t in ("dim_campaign", "dim_product")
    for i, n in enumerate(x for x in schemas.WAREHOUSE[t].names)))
def _(c: Context) -> DataFrame:
    tables, out = {t: c.dim(t) for t in ("dim_campaign", "dim_product")}, None
    for t in ("dim_campaign", "dim_product", "no_such_table"):
        if not c.store.exists(t):
            continue
        names = F.array(*[F.lit(n) for n in c.store.columns(t) if c.store.has_column(t, n)])
        rows = tables[t].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t).alias("table_name"), F.posexplode(names).alias("position", "column_name"), "row_count"
        )
        out = rows if out is None else out.union(rows)
    return out
