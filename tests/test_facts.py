import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_dimensions import T1, T2, customer, decimals, load, product, staged
from tillstar.operators import keys
from tillstar.plans import dimensions, facts, validation, warehouse
from tillstar.plans.facts import transaction_lines as lines
from tillstar.sources import tables

D = dt.date


def header(i, customer_id="c1", day=D(2019, 6, 1), load=T1, **more):
    return dict(transaction_id=i, customer_id=customer_id, transaction_date=dt.datetime.combine(day, dt.time(12)),
                tax_amount=Decimal(1), load_timestamp=load, load_id=int(load.month), row_hash=str(load)) | more


def item(i, txn, qty=2, price=10, discount=0, load=T1, product_id="p1"):
    return dict(transaction_item_id=i, transaction_id=txn, product_id=product_id, quantity=qty, unit_price=Decimal(price),
                line_total=Decimal(qty * price - discount), discount_amount=Decimal(discount), load_timestamp=load,
                load_id=int(load.month), row_hash=f"{i}{load}")


def star(spark):
    dim, _ = load(spark, None, [customer("c1"), customer("c2")], D(2019, 1, 1))
    return dim, dimensions.build_product(staged(spark, "stg_products", decimals([product("p1"), product("p2")])))


def build(spark, headers, items, **options):
    return facts.build_transactions(
        staged(spark, "stg_ecom_transactions", headers), staged(spark, "stg_ecom_transaction_items", items), *star(spark), **options
    )


def test_net_amount_subtracts_the_discount_from_the_line_total(spark):
    fact = build(spark, [header("t1")], [item("i1", "t1", discount=3)])
    assert rows(fact, "transaction_key", "transaction_date_key", "line_total", "net_amount") == [(1, 20190601, 17, 14)]


def test_sales_before_registration_and_unknown_products_are_dropped(spark):
    fact = build(spark, [header("t1", day=D(2018, 12, 31)), header("t2"), header("t3", customer_id="nobody")],
                 [item("i1", "t1"), item("i2", "t2", product_id="none"), item("i3", "t2"), item("i4", "t3")])
    assert rows(fact, "transaction_id") == [("t2",)]


def test_a_file_loaded_twice_does_not_multiply_lines(spark):
    fact = build(spark, [header("t1"), header("t1", load=T2)],
                 [item("i1", "t1"), item("i2", "t1"), item("i1", "t1", load=T2), item("i2", "t1", load=T2)])
    assert fact.count() == 2


def test_lines_without_item_id_are_all_kept(spark):
    fact = build(spark, [header("t1")], [item(None, "t1"), item(None, "t1"), item("i1", "t1")])
    assert rows(fact, "transaction_key") == [(1,), (2,), (3,)]


def test_late_lines_of_a_loaded_transaction_are_left_out(spark, store):
    dim_c, dim_p = star(spark)
    store.replace(dim_c, "dim_customer")
    store.replace(dim_p, "dim_product")

    def run(headers, items):
        return warehouse.load_transactions(
            store, staged(spark, "stg_ecom_transactions", headers), staged(spark, "stg_ecom_transaction_items", items)
        )

    assert run([header("t1")], [item("i1", "t1")]) == 1
    assert run([header("t1"), header("t2")], [item("i1", "t1"), item("i9", "t1"), item("i2", "t2")]) == 1
    assert run([header("t1"), header("t2")], [item("i1", "t1"), item("i9", "t1"), item("i2", "t2")]) == 0
    assert rows(store.read("fact_transactions"), "transaction_key", "transaction_id") == [(1, "t1"), (2, "t2")]


def test_unknown_response_type_sets_no_flag(spark):
    dim, _ = load(spark, None, [customer("c1")], D(2019, 1, 1))
    campaign = dimensions.build_campaign(staged(spark, "stg_marketing_campaigns", [
        dict(campaign_id="m1", load_timestamp=T1, load_id=1, row_hash="h")]))
    responses = staged(spark, "stg_campaign_responses", [
        dict(response_id=f"r{i}", campaign_id="m1", customer_id="c1", response_date=D(2020, 1, 1), response_type=kind,
             load_timestamp=T1, load_id=1, row_hash="h") for i, kind in enumerate(["opened", None, "other"])])
    fact = facts.build_responses(responses, dim, campaign)
    assert rows(fact, "response_id", "is_opened", "is_clicked", "is_converted") == [
        ("r0", True, False, False), ("r1", False, False, False), ("r2", False, False, False)]


def test_lifetime_metrics_belong_to_the_current_version(spark):
    first, _ = load(spark, None, [customer("c1")], D(2019, 1, 1))
    dim, _ = load(spark, first, [customer("c1", T2, city="moved")], D(2020, 1, 1))
    product_dim = dimensions.build_product(staged(spark, "stg_products", decimals([product("p1")])))
    fact = facts.build_transactions(
        staged(spark, "stg_ecom_transactions", [header("t1"), header("t2", day=D(2020, 5, 1))]),
        staged(spark, "stg_ecom_transaction_items", [item("i1", "t1"), item("i2", "t2")]), dim, product_dim)
    assert rows(dimensions.with_lifetime_metrics(dim, fact), "customer_key", "total_orders", "total_spent") == [
        (1, 0, 0), (2, 1, 20)]


def test_aggregates_add_up_to_the_fact(ctx):
    t = ctx.tables
    net = t["fact_transactions"].agg(F.sum("net_amount")).first()[0]
    assert t["agg_customer_monthly"].agg(F.sum("total_amount")).first()[0] == net
    assert t["agg_product_daily"].agg(F.sum("total_revenue")).first()[0] == net
    daily = t["agg_product_daily"]
    assert daily.filter("total_profit <> total_revenue - total_cost").count() == 0


def test_full_load_twice_changes_nothing(ctx, store):
    from tillstar.catalog.base import FIRST_LOAD

    tables, counts, seconds = warehouse.full_load(store, ctx.staged(), FIRST_LOAD)
    before = {n: rows(tables[n]) for n in ("dim_customer", "dim_product", "fact_transactions", "fact_campaign_responses")}
    again, counts_again, _ = warehouse.full_load(store, ctx.staged(), FIRST_LOAD)
    assert {n: rows(again[n]) for n in before} == before
    assert counts_again["transactions"] == 0 == counts_again["campaign_responses"] == counts_again["customers_new"]
    assert set(seconds) == {"dimensions", "facts", "metrics", "aggregates"} and counts["transactions"] > 0


def test_built_warehouse_meets_its_constraints(ctx):
    assert validation.constraint_report(ctx.tables).filter("violations > 0").count() == 0


def test_dates_outside_the_calendar_are_reported(ctx):
    damaged = dict(ctx.tables)
    damaged["fact_transactions"] = damaged["fact_transactions"].withColumn("transaction_date_key", F.lit(19000101))
    report = {(r["fact_table"], r["fk_column"]): r["orphan_count"] for r in validation.integrity_report(damaged).collect()}
    assert report[("fact_transactions", "transaction_date_key")] == ctx["fact_transactions"].count()
    assert report[("fact_transactions", "customer_key")] == 0


def test_sales_beyond_the_calendar_stay_in_every_report(spark, store):
    import datetime as dt

    from pyspark.sql import functions as F

    from tillstar.plans import analytics, facts, warehouse

    warehouse.load_dates(store, dt.date(2000, 1, 1), dt.date(2001, 12, 31))
    staged = spark.createDataFrame([(dt.datetime(2031, 5, 6),), (dt.datetime(2001, 5, 6),)], "transaction_date timestamp_ntz")
    warehouse.cover_dates(store, staged, "transaction_date")
    days = store.read("dim_date")
    assert days.agg(F.max("date_key"), F.min("date_key"), F.count("*")).first()[:2] == (20311231, 20000101)
    assert days.count() == days.select("date_key").distinct().count() == (dt.date(2031, 12, 31) - dt.date(1999, 12, 31)).days
    fact = spark.createDataFrame(
        [(1, 20310506, "T1", 2, "40.00", "0"), (1, 20010506, "T2", 1, "20.00", "0")],
        "customer_key bigint, transaction_date_key int, transaction_id string, quantity int, net string, off string",
    ).selectExpr("*", "cast(net as decimal(12,2)) as net_amount", "cast(off as decimal(10,2)) as discount_amount")
    assert {(r["year_month"], str(r["total_amount"])) for r in facts.customer_monthly(fact).collect()} == {
        (203105, "40.00"), (200105, "20.00")}
    assert analytics.with_dates(fact, days, "day_name").count() == 2


def test_totals_beyond_sixteen_digits(spark):
    from tillstar.functions import decimal_sum

    df = spark.range(4).selectExpr("cast(9999999999999999.99 as decimal(18,2)) as v")
    assert str(df.agg(decimal_sum("v").alias("t")).first()["t"]) == "39999999999999999.96"


def test_a_load_without_new_transactions_leaves_the_lines_alone(spark, store):
    dim, _ = load(spark, None, [customer("c1")], D(2019, 1, 1))
    store.replace(dim, "dim_customer")
    store.replace(dimensions.build_product(staged(spark, "stg_products", decimals([product("p1")]))), "dim_product")
    headers = staged(spark, "stg_ecom_transactions", [header("t1"), header("t2")])
    items = staged(spark, "stg_ecom_transaction_items", [item("i1", "t1"), item("i2", "t2")])
    assert warehouse.load_transactions(store, headers, items) == 2
    before = store.snapshot("fact_transactions")
    unread = items.withColumn("transaction_id", F.raise_error(F.lit("lines were read")).cast("string"))
    assert warehouse.load_transactions(store, headers, unread) == 0
    assert store.snapshot("fact_transactions") == before


def _exchanges(df):
    return len(re.findall(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString()))


def test_daily_sales_are_shuffled_once(spark, store):
    D0, hundred = 20190601, Decimal(100)
    fact = spark.createDataFrame(
        [(D0, 1, c, t, 1, hundred) for c, t in ((1, "t1"), (1, "t2"), (2, "t3"), (None, "t4"))] + [(D0 + 1, 1, 2, "t5", 3, None)],
        "transaction_date_key int, product_key bigint, customer_key bigint, transaction_id string, quantity int, net_amount decimal(12,2)")
    store.replace(fact, "f")
    product = spark.createDataFrame([(1, Decimal(40))], "product_key bigint, unit_cost decimal(10,2)")
    plain = facts.product_daily(store.read("f"), product)
    ranged = facts.product_daily(facts.by_day_and_product(store.read("f")), product)
    # one exchange less for the count of customers, and none to gather the days of a month
    assert _exchanges(ranged) < _exchanges(plain)
    assert rows(ranged) == rows(plain) == rows(facts.product_daily(facts.by_day_and_product(store.read("f"), 7), product))
    assert rows(ranged, "date_key", "units_sold", "unique_customers", "total_revenue") == [(D0, 4, 2, 400), (D0 + 1, 3, 1, None)]


def test_aggregates_by_month_without_a_sort_by_folder(spark, store):
    """Months are written side by side, more of them than files may be open too; the session is left as it was."""
    months = spark.range(2000).select((F.col("id") % 40).cast("string").alias("m"), "id")
    for gathered in (True, False):
        store.replace(months.repartition(3), "t", slot=F.col("m"), gathered=gathered)
        assert len({p.slot for p in store.snapshot("t").parts}) == 40
        assert rows(store.read("t")) == rows(months)
    assert spark.conf.get(tables._OPEN_FILES, "0") == "0"


def test_repeated_keys_of_a_long_table(spark, monkeypatch):
    df = spark.range(3000).selectExpr("if(id < 4, null, id div 2) as k", "id % 2 as part")
    for limit in (250_000, 100):
        monkeypatch.setattr(keys, "RANGE_ROWS", limit)
        found = validation.repeated_keys(df, ("k",))
        assert found.count() == 1499 and rows(found.filter("k is null"), "count") == [(4,)]
        assert validation.repeated_keys(df.filter("k is not null"), ("k", "part")).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    # keys are dealt before they are counted, so no task holds the keys of a whole split
    assert plan.index("HashAggregate") < plan.index("Exchange") and "hashpartitioning(k" in plan and ", 30)" in plan


def test_headers_without_copies_are_not_ranked(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(facts, "transaction_lines", lambda t, *more, **options: seen.append((t, options["reduced"])) or lines(t, *more, **options))
    fact = build(spark, [header("t1"), header("t2"), header("t2", load=T2, order_number="new"), header(None), header("t3", customer_id=None)],
                 [item("i1", "t1"), item("i2", "t2"), item("i3", "t3")])
    assert rows(fact, "transaction_id", "order_number") == [("t1", None), ("t2", "new")]
    assert seen[0][1] and seen[0][0].count() == 2
