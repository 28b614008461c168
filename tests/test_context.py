"""What a query makes the catalogue build."""

import shutil

from tillstar.catalog import QUERIES, Context
from tests.conftest import SMALL


def _fresh(spark, tmp_path):
    """A context of a folder that nothing was built for yet."""
    folder = f"{tmp_path}/tables"
    shutil.copytree(SMALL, folder)
    return Context(spark, folder)


def test_customers_are_queried_without_facts_or_orders(spark, tmp_path):
    c = _fresh(spark, tmp_path)
    QUERIES["S08_parameterised_query"](spark, c.folder).collect()
    assert c._built == {"dimensions", "stg_customers_first", "stg_customers_second", "stg_products", "stg_marketing_campaigns"}
    assert not any(c.store.exists(n) for n in ("fact_transactions", "fact_campaign_responses", "agg_product_daily"))


def test_sales_of_customers_are_built_without_aggregates_and_responses(spark, tmp_path):
    c = _fresh(spark, tmp_path)
    bought = c["dim_customer"].filter("total_orders > 0").count()
    assert bought and c.store.exists("fact_transactions")
    assert not any(c.store.exists(n) for n in ("fact_campaign_responses", "agg_customer_monthly", "agg_product_daily"))
    assert not c.staging.exists("stg_ecom_transaction_items")


def test_lookup_of_orphans_stores_no_staged_orders_and_lines(spark, tmp_path):
    c = _fresh(spark, tmp_path)
    assert QUERIES["J13_left_lookup_keeping_orphans"](spark, c.folder).count()
    assert not any(c.staging.exists(n) for n in ("stg_ecom_transactions", "stg_ecom_transaction_items"))
