"""Snapshots, the id ledger, and upkeep of stored tables from what was added."""

import datetime as dt
import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_dimensions import T1, T2, customer, decimals, product, staged
from tests.test_facts import header, item
from tillstar.plans import dimensions, facts, maintenance, warehouse
from tillstar.sources import tables
from tillstar.sources.ledger import IdLedger

D = dt.date


def files_of(df):
    return sorted(re.sub(r"^file:/*", "/", f) for f in df.inputFiles())


# --- snapshots -------------------------------------------------------------------------------


def test_many_appends_read_as_few_parts_and_old_readers_go_on(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_PARTS", 4)
    store.append(spark.range(0, 2).toDF("x"), "t")
    first = store.snapshot("t").number
    reader = store.read("t")
    for i in range(1, 14):
        store.append(spark.range(2 * i, 2 * i + 2).toDF("x"), "t")
    assert len(store.batches("t")) <= 5
    assert sorted(r.x for r in store.read("t").collect()) == list(range(28))
    assert reader.count() == 2 and store.read("t", number=first).count() == 2
    # what was appended since can be read by itself, merged or not
    added = store.added_since("t", first)
    assert sorted(r.x for r in store.read_parts("t", added).collect()) == list(range(2, 28))
    assert store.expire("t", keep=2) > 0
    assert store.count("t") == 28 and len(store.numbers("t")) == 2 and store.added_since("t", first) is None
    assert store.expire("t", keep=2) == 0


def test_compaction_keeps_storage_partitions_and_the_order_in_them(spark, store):
    df = spark.range(30).select(F.col("id").alias("x"), (F.col("id") % 3).cast("int").alias("p"))
    for k in range(3):
        store.append(df.filter(F.col("x") % 2 == k % 2).filter(F.col("x") >= 10 * k), "t", ["p"], highest=["x"])
    before = rows(store.read("t"), "x", "p")
    assert store.compact("t", sort_by=["x"]) == 3 and rows(store.read("t"), "x", "p") == before
    assert store.highest("t", "x") == 29 and len(store.batches("t")) == 1
    assert all("/p=" in f for f in store.read("t").inputFiles())
    assert store.compact("t") == 0


def test_columns_that_come_later_are_missing_in_earlier_rows(spark, store):
    store.append(spark.sql("select 1 as x"), "t")
    store.append(spark.sql("select 2 as x, 'b' as y"), "t")
    store.append(spark.sql("select 3 as x"), "t")
    assert rows(store.read("t"), "x", "y") == [(1, None), (2, "b"), (3, None)]
    with pytest.raises(TypeError):
        store.append(spark.sql("select 'z' as x"), "t")
    assert store.count("t") == 3 and store.append(spark.sql("select 4 as x").limit(0), "t") == 0


def test_slots_are_rewritten_alone_and_conflicts_are_noticed(spark, store):
    df = spark.range(20).select(F.col("id").alias("x"), (F.col("id") % 4).cast("string").alias("s"))
    store.replace(df, "t", slot=F.col("s"))
    before = store.snapshot("t")
    kept = files_of(store.read("t", slots=["0", "2", "3"]))
    store.rewrite(store.read("t", slots=["1"]).withColumn("x", -F.col("x")), "t", F.col("s"), instead_of=["1"], based_on=before)
    assert files_of(store.read("t", slots=["0", "2", "3"])) == kept
    assert rows(store.read("t"), "x") == sorted(((-x if x % 4 == 1 else x,) for x in range(20)), key=repr)
    with pytest.raises(tables.ChangedMeanwhile):
        store.rewrite(df.filter("s = '1'"), "t", F.col("s"), instead_of=["1"], based_on=before)
    store.rewrite(df.filter("s = '9'"), "t", F.col("s"), instead_of=["0"])
    assert store.read("t").filter("s = '0'").count() == 0
    with pytest.raises(ValueError):
        store.compact("t")


def test_two_appends_at_once_both_count(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    store.append(spark.range(1).toDF("x"), "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.append(spark.range(i, i + 1).toDF("x"), "t"), range(1, 9)))
    assert sorted(r.x for r in store.read("t").collect()) == list(range(9))


# --- ledger ----------------------------------------------------------------------------------


def test_ledger_reads_the_buckets_of_the_batch_only(spark, store):
    ids = lambda a, b: spark.range(a, b).select(F.concat(F.lit("t"), F.col("id")).alias("k"))
    store.append(ids(0, 400), "fact")
    ledger = IdLedger(store, "fact", "k", bucket_ids=20, waiting_ids=30, least_buckets=4)
    few = ids(5, 7)
    found = ledger.candidates(few)
    assert store.properties("fact_ids")["buckets"] >= 20
    assert {"t5", "t6"} <= {r.k for r in found.collect()} and found.count() < 100
    everything = len(store.read("fact_ids").inputFiles())
    assert len(found.inputFiles()) <= 2 < everything
    # small batches wait, and are folded into their buckets when they are many
    for a in range(400, 500, 20):
        store.append(ids(a, a + 20), "fact")
        assert {r.k for r in ledger.candidates(ids(a, a + 1)).collect()} >= {f"t{a}"}
        assert store.properties("fact_ids")["waiting"] <= 30
    assert sorted(r.k for r in store.read("fact_ids").collect()) == sorted(f"t{i}" for i in range(500))
    # a fact that was written anew is listed anew
    store.replace(ids(0, 3), "fact")
    ledger.catch_up()
    assert sorted(r.k for r in store.read("fact_ids").collect()) == ["t0", "t1", "t2"]


def test_responses_are_found_in_the_list_and_not_in_the_fact(spark, store):
    dim = dimensions.build_campaign(staged(spark, "stg_marketing_campaigns", [dict(campaign_id="m1", load_timestamp=T1, load_id=1, row_hash="h")]))
    store.replace(dim, "dim_campaign")
    warehouse.load_customers(store, staged(spark, "stg_crm_customers", [customer("c1")]), D(2019, 1, 1))

    def batch(*ids):
        return staged(spark, "stg_campaign_responses", [
            dict(response_id=i, campaign_id="m1", customer_id="c1", response_date=D(2020, 1, 1), response_type="opened",
                 load_timestamp=T1, load_id=1, row_hash="h") for i in ids])

    assert warehouse.load_responses(store, batch("r1", "r2", "r2")) == 2
    assert warehouse.load_responses(store, batch("r2", "r3", None)) == 1
    assert warehouse.load_responses(store, batch("r1", "r2", "r3")) == 0
    assert rows(store.read("fact_campaign_responses"), "response_key", "response_id") == [(1, "r1"), (2, "r2"), (3, "r3")]
    # the third load reads ids and a manifest: with the fact's rows gone it would find the same
    data = store.path("fact_campaign_responses") + "/data"
    os.rename(data.removeprefix("file:"), data.removeprefix("file:") + "-away")
    assert warehouse.load_responses(store, batch("r1", "r3")) == 0


# --- loads in several batches ----------------------------------------------------------------


def batches():
    """Orders of three loads: new months, a month again, nothing new, late and early days."""
    days = [[D(2019, 6, 1), D(2019, 6, 9), D(2020, 12, 31)], [D(2019, 6, 2), D(2021, 1, 1)], [], [D(2019, 5, 31), D(2021, 1, 2)]]
    n = 0
    for load in days:
        headers, items = [], []
        for day in load:
            for c in ("c1", "c2", "c3")[: 1 + n % 3]:
                n += 1
                headers.append(header(f"t{n}", c, day))
                items += [item(f"i{n}a", f"t{n}", qty=n), item(f"i{n}b", f"t{n}", product_id="p2", price=7, discount=1)]
        yield headers, items


def start(spark, store):
    warehouse.load_customers(store, staged(spark, "stg_crm_customers", [customer(f"c{i}") for i in range(1, 40)]), D(2019, 1, 1))
    store.replace(dimensions.build_product(staged(spark, "stg_products", decimals([product("p1"), product("p2")]))), "dim_product")


def test_aggregates_and_metrics_of_several_loads_equal_a_rebuild(spark, store):
    start(spark, store)
    seen_items = []
    for number, (headers, items) in enumerate(batches()):
        seen_items += items
        warehouse.load_transactions(
            store, staged(spark, "stg_ecom_transactions", headers), staged(spark, "stg_ecom_transaction_items", seen_items))
        june = files_of(store.read("agg_customer_monthly", slots=["202012"])) if number else None
        if number == 3:  # a customer moves between loads, and a product gets another cost
            warehouse.load_customers(store, staged(spark, "stg_crm_customers", [customer("c2", T2, city="moved")]), D(2021, 1, 2))
            costs = store.read("dim_product").withColumn("unit_cost", F.expr("cast(unit_cost + 1 as decimal(10,2))"))
            store.replace(costs.select(*store.columns("dim_product")), "dim_product")
        counts = warehouse.build_aggregates(store)
        warehouse.refresh_metrics(store)
        fact, dim = store.read("fact_transactions"), store.read("dim_customer")
        whole = facts.customer_monthly(fact)
        assert rows(store.read("agg_customer_monthly"), *whole.columns) == rows(whole) and counts["agg_customer_monthly"] == whole.count()
        daily = facts.product_daily(fact, store.read("dim_product"))
        assert rows(store.read("agg_product_daily"), *daily.columns) == rows(daily)
        assert rows(dim) == rows(dimensions.with_lifetime_metrics(dim, fact), *dim.columns)
        assert dim.filter("total_orders > 0").count() >= 2
        if number:  # a month without new lines keeps its files
            assert files_of(store.read("agg_customer_monthly", slots=["202012"])) == june
    assert store.snapshot("agg_customer_monthly").version == 1


def test_upkeep_of_aggregates_reads_touched_years_only(spark, store):
    start(spark, store)
    loads = list(batches())
    load = lambda h, i: warehouse.load_transactions(
        store, staged(spark, "stg_ecom_transactions", h), staged(spark, "stg_ecom_transaction_items", i))
    load(*loads[0])
    warehouse.build_aggregates(store)
    load(*loads[1])
    added = store.added_since("fact_transactions", store.properties("agg_customer_monthly")["covers"])
    months = facts.months_of(store.read_parts("fact_transactions", added))
    assert months == [201906, 202101]
    plan = facts.within_months(store.read("fact_transactions"), months)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and re.search(r"PartitionFilters: \[[^\]]*transaction_year", text)
    assert re.search(r"PushedFilters: \[[^\]]*transaction_date_key", text)
    years = {re.search(r"transaction_year=(\d+)", r.file_path)[1] for r in plan.select("_metadata.file_path").collect()}
    assert years == {"2019", "2021"}


def test_a_crash_between_two_commits_is_made_up_for(spark, store, monkeypatch):
    start(spark, store)
    (h, i), (h2, i2), *_ = batches()
    warehouse.load_transactions(store, staged(spark, "stg_ecom_transactions", h), staged(spark, "stg_ecom_transaction_items", i))
    warehouse.refresh_metrics(store)
    warehouse.load_transactions(store, staged(spark, "stg_ecom_transactions", h2), staged(spark, "stg_ecom_transaction_items", i2))
    maintenance.fold_sales(store)  # and then the load dies
    warehouse.refresh_metrics(store)
    dim, fact = store.read("dim_customer"), store.read("fact_transactions")
    assert rows(dim) == rows(dimensions.with_lifetime_metrics(dim, fact), *dim.columns)
    monkeypatch.setattr(maintenance, "MOST_FOLDS", 0)
    warehouse.load_transactions(store, staged(spark, "stg_ecom_transactions", [header("t99", "c9")]),
                                staged(spark, "stg_ecom_transaction_items", [item("i99", "t99")]))
    warehouse.refresh_metrics(store)
    assert store.read("dim_customer").filter("customer_id = 'c9'").first()["total_spent"] == Decimal(20)
    assert store.read("customer_sales").groupBy("customer_key").count().filter("count > 1").count() == 0


def test_a_merge_leaves_the_files_of_unchanged_buckets(spark, store):
    start(spark, store)
    before = store.snapshot("dim_customer")
    changed = [customer("c1", T2, city="moved"), customer("c2", T2, email="new@x"), customer("c3", T2), customer("c99", T2)]
    warehouse.load_customers(store, staged(spark, "stg_crm_customers", changed), D(2020, 1, 1))
    after = store.snapshot("dim_customer")
    touched = {r.b for r in spark.createDataFrame([("c1",), ("c2",), ("c99",)], "customer_id string").select(
        maintenance._bucket(before.properties["buckets"]).alias("b")).collect()}
    for part in before.parts:
        assert (part in after.parts) == (part.slot[1:] not in touched)
    # a second change of the same customer adds to history without touching its files
    history = [p for p in after.parts if p.slot.startswith("h")]
    assert len(history) == 1
    warehouse.load_customers(store, staged(spark, "stg_crm_customers", [customer("c1", T2, city="again")]), D(2020, 2, 1))
    assert all(p in store.snapshot("dim_customer").parts for p in history)
    got = store.read("dim_customer").filter("customer_id = 'c1'")
    assert rows(got, "customer_key", "city", "valid_from", "valid_to", "is_current") == [
        (1, "c", D(2019, 1, 1), D(2020, 1, 1), False), (40, "moved", D(2020, 1, 1), D(2020, 2, 1), False),
        (42, "again", D(2020, 2, 1), D(9999, 12, 31), True)]
    number = store.snapshot("dim_customer").number
    warehouse.load_customers(store, staged(spark, "stg_crm_customers", [customer("c1", T2, city="again")]), D(2020, 3, 1))
    assert store.snapshot("dim_customer").number == number  # nothing changed, nothing written


def test_merge_by_bucket_equals_the_merge_of_the_whole(ctx, store):
    from tillstar.catalog.base import FIRST_LOAD, SECOND_LOAD

    first, second = ctx.stg("stg_customers_first"), ctx.stg("stg_customers_second")
    warehouse.load_customers(store, first, FIRST_LOAD)
    warehouse.load_customers(store, second, SECOND_LOAD)
    merged = dimensions.merge_customer(ctx.first_load(), second, SECOND_LOAD).dim
    assert rows(store.read("dim_customer")) == rows(merged, *store.columns("dim_customer"))
    assert maintenance.upkeep(store, keep=1)["dim_customer"] >= 0 and rows(store.read("dim_customer")) == rows(merged)
