"""Incremental and streaming loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.catalog.base import Context, query
from tillstar.catalog.fact_queries import _summary, _summary_sql
from tillstar.sources.tables import TableStore
from tillstar.streaming import arrivals, incremental

MARK = dt.datetime(2001, 6, 15)


@query("I01_high_water_mark", """
    select customer_id, '2001-07-01 00:00:00' as mark, cast(0 as bigint) as left_over
    from stg_crm_customers where load_day > date '2001-06-15'""")
def _(c: Context) -> DataFrame:
    store, staged = TableStore(c.spark, c.scratch("marks")), c.stg("stg_crm_customers")
    incremental.advance(store, "customers", MARK)
    pulled = incremental.pull(store, staged, "customers")
    incremental.advance(store, "customers", pulled.mark)
    again = incremental.pull(store, staged, "customers").rows.agg(F.count(F.lit(1))).scalar()
    return pulled.rows.select("customer_id").withColumns(
        {"mark": F.lit(str(pulled.mark)), "left_over": again}
    )


def _star(c: Context, name: str) -> TableStore:
    store = TableStore(c.spark, c.scratch(name))
    for dim in ("dim_customer", "dim_product", "dim_campaign"):
        store.replace(c.dim(dim), dim)
    return store


@query("I02_incremental_load", _summary_sql("fact_transactions").replace(
    "select ", "select (select count(*) from fact_transactions) as loaded, cast(0 as bigint) as loaded_again, ", 1))
def _(c: Context) -> DataFrame:
    # orders before some of their lines and customers; odd orders commit last with an earlier stamp;
    # the last call finds nothing new
    store, staging = _star(c, "increment"), TableStore(c.spark, c.scratch("arrived"))
    number = F.substring("transaction_id", 4, 20).cast("bigint")
    odd = number % 2 == 1
    orders = c.stg("stg_ecom_transactions").withColumns({
        "load_timestamp": F.when(odd, F.col("load_timestamp") - F.expr("interval 1 day")).otherwise(F.col("load_timestamp")),
        "load_id": F.when(odd, F.col("load_id") - 1).otherwise(F.col("load_id")),
    })
    items, customers = c.stg("stg_ecom_transaction_items"), store.read("dim_customer")
    staging.replace(items.filter(number % 5 < 3), "stg_ecom_transaction_items")
    staging.replace(c.stg("stg_campaign_responses"), "stg_campaign_responses")
    staging.replace(orders.filter(~odd), "stg_ecom_transactions")
    store.replace(customers.filter("pmod(hash(customer_id), 3) > 0"), "dim_customer")
    loaded = incremental.load_increment(store, staging)["transactions"]
    staging.append(items.filter(number % 5 >= 3), "stg_ecom_transaction_items")
    staging.append(orders.filter(odd), "stg_ecom_transactions")
    loaded += incremental.load_increment(store, staging)["transactions"]
    store.replace(customers, "dim_customer")
    loaded += incremental.load_increment(store, staging)["transactions"]
    again = incremental.load_increment(store, staging)["transactions"]
    return _summary(store.read("fact_transactions")).withColumns(
        {"loaded": F.lit(loaded).cast("bigint"), "loaded_again": F.lit(again).cast("bigint")}
    )


@query("I03_arriving_files", _summary_sql("fact_transactions"))
def _(c: Context) -> DataFrame:
    store, staging = _star(c, "stream"), TableStore(c.spark, c.scratch("arrived"))
    folder, checkpoint = c.scratch("incoming"), c.scratch("progress")
    # lines are written once, where they are staged; a delivery of orders is as many files as tasks write at a time
    orders, items = c.stg("stg_ecom_transactions"), c.passing("stg_ecom_transaction_items")
    third, files = F.substring("transaction_id", 4, 20).cast("bigint") % 3, c.spark.sparkContext.defaultParallelism
    # lines of some orders are staged after the orders have arrived
    staging.replace(items.filter(third > 0), "stg_ecom_transaction_items")
    orders.filter(third < 2).repartition(2 * files).write.parquet(folder)
    arrivals.load_arriving_transactions(store, staging, folder, checkpoint, files_per_batch=files).awaitTermination()
    staging.append(items.filter(third == 0), "stg_ecom_transaction_items")
    # the rest arrives together with copies of what is already loaded
    orders.filter(third > 0).write.mode("append").parquet(folder)
    arrivals.load_arriving_transactions(store, staging, folder, checkpoint).awaitTermination()
    return _summary(store.read("fact_transactions"))


@query("I03_arriving_responses", """
    select response_type, count(*) as responses, count(distinct response_key) as keys from fact_campaign_responses
    group by response_type""")
def _(c: Context) -> DataFrame:
    store = _star(c, "stream")
    folder, checkpoint = c.scratch("incoming"), c.scratch("progress")
    c.stg("stg_campaign_responses").repartition(2).write.parquet(folder)
    arrivals.load_arriving_responses(store, folder, checkpoint, files_per_batch=1).awaitTermination()
    arrivals.load_arriving_responses(store, folder, checkpoint).awaitTermination()
    return store.read("fact_campaign_responses").groupBy("response_type").agg(
        F.count(F.lit(1)).alias("responses"), F.count_distinct("response_key").alias("keys")
    )
