import datetime as dt

import pytest

from pyspark.sql import functions as F

from tests.conftest import rows
from tillstar import schemas
from tillstar.plans import dimensions

D = dt.date
T1, T2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1)


def staged(spark, name, records):
    """Staging rows from partial dicts."""
    schema = schemas.STAGING[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in records], schema)


def customer(i, load=T1, **changes):
    base = dict(
        customer_id=i, first_name="A", last_name="B", email=f"{i}@x.com", phone_number="1", date_of_birth=D(1980, 1, 1),
        address="a", city="c", state="s", postal_code="p", country="X", registration_date=D(2019, 1, 1),
        customer_segment="Basic", account_status="Active", load_timestamp=load, load_id=int(load.month), row_hash=str(load),
    )
    return base | changes


def load(spark, dim, records, as_of):
    source = dim if dim is not None else dimensions.empty(spark, "dim_customer")
    merged, changes = dimensions.merge_customer(source, staged(spark, "stg_crm_customers", records), as_of)
    return merged, {r["change"]: r["customers"] for r in changes.collect()}


def test_first_load_is_valid_from_registration(spark):
    dim, counts = load(spark, None, [customer("c1"), customer("c2", registration_date=D(2018, 5, 5))], D(2020, 1, 1))
    assert counts == {"new": 2}
    assert rows(dim, "customer_key", "customer_id", "valid_from", "valid_to", "is_current", "total_orders") == [
        (1, "c1", D(2019, 1, 1), D(9999, 12, 31), True, 0), (2, "c2", D(2018, 5, 5), D(9999, 12, 31), True, 0),
    ]


def test_second_snapshot_versions_updates_and_keeps(spark):
    first, _ = load(spark, None, [customer("c1"), customer("c2"), customer("c3"), customer("c4", phone_number=None)], D(2020, 1, 1))
    second = [
        customer("c1", T2, city="moved", email="new@x.com"),  # tracked change: new version
        customer("c2", T2, phone_number="9", last_name="Z"),  # in place; the name is not refreshed
        customer("c3", T2, last_name="Z"),                    # neither tracked nor in place
        customer("c4", T2, phone_number=None),                # NULL equals NULL
        customer("c5", T2),
    ]
    dim, counts = load(spark, first, second, D(2020, 2, 1))
    assert counts == {"new": 1, "scd2_changed": 1, "type1_changed": 1, "unchanged": 2}
    assert rows(dim, "customer_key", "customer_id", "city", "phone_number", "last_name", "email", "valid_from", "valid_to", "is_current") == [
        (1, "c1", "c", "1", "B", "c1@x.com", D(2019, 1, 1), D(2020, 2, 1), False),
        (2, "c2", "c", "9", "B", "c2@x.com", D(2019, 1, 1), D(9999, 12, 31), True),
        (3, "c3", "c", "1", "B", "c3@x.com", D(2019, 1, 1), D(9999, 12, 31), True),
        (4, "c4", "c", None, "B", "c4@x.com", D(2019, 1, 1), D(9999, 12, 31), True),
        (5, "c1", "moved", "1", "B", "new@x.com", D(2020, 2, 1), D(9999, 12, 31), True),
        (6, "c5", "c", "1", "B", "c5@x.com", D(2019, 1, 1), D(9999, 12, 31), True),
    ]


def test_merging_the_same_snapshot_again_changes_nothing(spark):
    records = [customer("c1"), customer("c2", phone_number=None)]
    first, _ = load(spark, None, records, D(2020, 1, 1))
    again, counts = load(spark, first, records, D(2020, 3, 1))
    assert counts == {"unchanged": 2}
    assert rows(again) == rows(first)


def test_customers_missing_from_a_snapshot_stay_current(spark):
    first, _ = load(spark, None, [customer("c1"), customer("c2")], D(2020, 1, 1))
    dim, _ = load(spark, first, [customer("c1", T2)], D(2020, 2, 1))
    assert rows(dim.filter("is_current"), "customer_id") == [("c1",), ("c2",)]


def test_versions_of_a_customer_do_not_overlap_and_one_is_current(ctx):
    dim = ctx["dim_customer"]
    assert dim.groupBy("customer_id").agg(F.count_if("is_current").alias("n")).filter("n <> 1").count() == 0
    a, b = dim.alias("a"), dim.alias("b")
    overlap = (
        (F.col("a.customer_id") == F.col("b.customer_id")) & (F.col("a.customer_key") < F.col("b.customer_key"))
        & (F.col("a.valid_from") < F.col("b.valid_to")) & (F.col("b.valid_from") < F.col("a.valid_to"))
    )
    assert a.join(b, overlap).count() == 0


def test_a_missing_name_part_leaves_the_full_name_missing(spark):
    df = dimensions.derive_customer(staged(spark, "stg_crm_customers", [customer("c1", last_name=None)]), D(2020, 1, 1))
    assert rows(df, "full_name", "age", "age_group") == [(None, 40, "36-45")]


def product(i, load=T1, **changes):
    base = dict(product_id=i, product_name="n", product_category="k", brand="b", unit_cost=6, retail_price=10,
                product_status="Active", load_timestamp=load, load_id=int(load.month), row_hash=str(load) + str(changes))
    return base | changes


def decimals(records):
    from decimal import Decimal

    return [{k: Decimal(v) if k in ("unit_cost", "retail_price", "budget") and v is not None else v for k, v in r.items()} for r in records]


def test_two_staged_rows_of_a_product_give_one_dimension_row(spark):
    records = decimals([product("p1"), product("p1", T2, retail_price=0), product(None)])
    dim = dimensions.build_product(staged(spark, "stg_products", records))
    assert rows(dim, "product_id", "retail_price", "margin_percentage", "is_active") == [("p1", 0, None, True)]


def test_type_one_upsert_keeps_keys_and_unmentioned_rows(spark):
    first = dimensions.build_product(staged(spark, "stg_products", decimals([product("p1"), product("p3")])))
    later = staged(spark, "stg_products", decimals([product("p3", T2, retail_price=12, product_status=None), product("p2", T2)]))
    assert rows(dimensions.upsert_product(first, later), "product_key", "product_id", "retail_price", "is_active") == [
        (1, "p1", 10, True), (2, "p3", 12, False), (3, "p2", 10, True),
    ]


def test_known_campaigns_change_only_on_request(spark):
    def campaign(i, budget):
        return dict(campaign_id=i, campaign_name="n", start_date=D(2020, 1, 1), end_date=D(2020, 1, 11), budget=budget,
                    load_timestamp=T1, load_id=1, row_hash="h")

    first = dimensions.build_campaign(staged(spark, "stg_marketing_campaigns", decimals([campaign("m1", 5)])))
    later = staged(spark, "stg_marketing_campaigns", decimals([campaign("m1", 9), campaign("m2", 7)]))
    assert rows(dimensions.load_campaign(first, later), "campaign_key", "budget", "duration_days") == [(1, 5, 10), (2, 7, 10)]
    assert rows(dimensions.load_campaign(first, later, update=True), "campaign_key", "budget") == [(1, 9), (2, 7)]


def test_date_dimension_has_every_day_once_with_monday_weeks(spark):
    dim = dimensions.build_date(spark, D(2020, 1, 1), D(2030, 12, 31))
    assert dim.count() == 4018 == dim.select("date_key").distinct().count()
    assert dim.schema.names == schemas.WAREHOUSE["dim_date"].names
    sunday = dim.filter("date_key = 20240303").first()
    assert (sunday["day_of_week"], sunday["day_name"], sunday["week_start_date"], sunday["is_weekend"]) == (
        0, "Sunday", D(2024, 2, 26), True,
    )
    assert (sunday["month_end_date"], sunday["quarter_end_date"]) == (D(2024, 3, 31), D(2024, 3, 31))


def test_versions_without_is_current_survive_a_merge(spark):
    import datetime as dt

    from tillstar.operators.scd import scd2_merge

    dim = spark.createDataFrame(
        [(1, "A", "x", dt.date(2000, 1, 1), dt.date(9999, 12, 31), True), (2, "B", "y", dt.date(2000, 1, 1), dt.date(2000, 6, 1), None)],
        "k bigint, id string, v string, valid_from date, valid_to date, is_current boolean")
    staged = spark.createDataFrame([("A", "z", dt.date(2000, 1, 1))], "id string, v string, since date")

    def merge(day):
        return scd2_merge(dim, staged, day, business_key="id", surrogate="k", tracked=["v"], in_place=[], first_valid_from="since")

    assert sorted((r["k"], r["v"], r["is_current"]) for r in merge(dt.date(2001, 1, 1)).dim.collect()) == [
        (1, "x", False), (2, "y", None), (3, "z", True)]
    with pytest.raises(ValueError):
        merge(dt.date(1999, 1, 1))
