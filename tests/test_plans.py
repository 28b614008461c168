"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillstar.catalog import QUERIES
from tillstar.plans import analytics, facts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "QK"))
def test_reports_stay_in_the_jvm_and_never_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_recent_months_prune_years_and_push_the_date_bound(ctx):
    from tillstar.catalog.base import SALES_AS_OF

    text = ctx.tables["fact_transactions"]
    text = plan(analytics.monthly_revenue(text, ctx["dim_date"], SALES_AS_OF))
    assert re.search(r"PartitionFilters: \[[^\]]*transaction_year", text)
    assert "GreaterThanOrEqual(transaction_date_key,20000801)" in text


def test_reports_read_only_their_columns(ctx):
    text = plan(analytics.category_performance(ctx["fact_transactions"], ctx["dim_product"]))
    assert "order_number" not in text and "payment_method" not in text


def test_hot_transaction_is_split(spark, ctx):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    transactions, items = ctx.stg("stg_ecom_transactions"), ctx.stg("stg_ecom_transaction_items")
    customer, product = ctx.dim("dim_customer"), ctx.dim("dim_product")
    hot_id = ctx["fact_transactions"].agg(F.max("transaction_id")).first()[0]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        third = F.xxhash64("transaction_id", "product_id", "quantity", "line_total") % 3 == 0
        hot = items.withColumn("transaction_id", F.when(third, F.lit(hot_id)).otherwise(F.col("transaction_id"))).repartition(8)
        lines = facts.transaction_lines(transactions, hot, customer, product).select("transaction_id", "customer_key", "product_key")
        assert lines.filter(F.col("transaction_id") == hot_id).count() > items.count() / 4
        lines.collect()
        assert "skew=true" in plan(lines)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_headers_of_a_batch_are_not_ranked_again(spark, ctx):
    headers = spark.createDataFrame(
        [("t1", "c1", "o1"), ("t2", None, "o2"), ("t3", "c1", "o3")], "transaction_id string, customer_id string, order_number string"
    ).selectExpr("*", "date '2001-05-05' as transaction_date", "'cash' as payment_method", "'Completed' as payment_status",
                 "cast(0 as decimal(10,2)) as tax_amount", "cast(0 as decimal(10,2)) as shipping_amount", "'USD' as currency_code")
    items = spark.createDataFrame(
        [(None, "t1", "p1"), (None, "t2", "p1"), (None, "t3", "p1"), (None, "t3", "p1")],
        "transaction_item_id string, transaction_id string, product_id string",
    ).selectExpr("*", "1 as quantity", "2.0 as unit_price", "2.0 as line_total", "0.5 as discount_amount")
    customer = spark.sql("select 'c1' as customer_id, 1L as customer_key, date '2000-01-01' as valid_from, date '9999-12-31' as valid_to")
    product = spark.sql("select 'p1' as product_id, 1L as product_key")
    ranked = facts.transaction_lines(headers, items, customer, product)
    once = facts.transaction_lines(headers, items, customer, product, only_of=headers.select("transaction_id"), reduced=True)
    # the ranking of staged lines that have an id is left; plans are looked at before they run, where they hold each step once
    assert plan(once).count("row_number()") < plan(ranked).count("row_number()")
    assert sorted(r.transaction_id for r in once.collect()) == ["t1", "t3", "t3"]
    assert sorted(once.collect(), key=repr) == sorted(ranked.select(*once.columns).collect(), key=repr)
