import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from tillstar.plans import analytics, kpis
from tillstar.plans.dimensions import build_date

D = dt.date


def sales(spark, records):
    return spark.createDataFrame(records, "transaction_id string, customer_key bigint, transaction_date_key int, net int").select(
        "transaction_id", "customer_key", "transaction_date_key", F.col("net").cast("decimal(12,2)").alias("net_amount"))


def calendar(spark):
    return build_date(spark, D(2020, 1, 1), D(2022, 12, 31))


def test_year_over_year_skips_months_without_a_year_before(spark):
    fact = sales(spark, [("a", 1, 20200105, 100), ("b", 1, 20200301, 50), ("c", 1, 20210120, 150), ("d", 1, 20210210, 70)])
    assert rows(analytics.year_over_year(fact, calendar(spark)), "current_year", "month_number", "revenue_change", "yoy_growth_percentage") == [
        (2021, 1, 50, 50.0)]


def test_month_over_month_counts_missing_months_as_zero(spark):
    fact = sales(spark, [("a", 1, 20200105, 100), ("b", 1, 20200301, 50)])
    assert rows(kpis.month_over_month(fact, calendar(spark)), "month_start", "revenue", "growth_percentage") == [
        (D(2020, 1, 1), 100, None), (D(2020, 2, 1), 0, -100.0), (D(2020, 3, 1), 50, None)]


def test_churn_leaves_never_buyers_out_of_the_risk(spark):
    dim = spark.createDataFrame([(1, "s", True), (2, "s", True), (3, "s", True)], "customer_key bigint, customer_segment string, is_current boolean")
    fact = sales(spark, [("a", 1, 20200101, 1), ("b", 2, 20201231, 1)])
    assert rows(analytics.churn_by_segment(dim, fact, calendar(spark), D(2021, 1, 1))) == [("s", 3, 1, 33.33)]


def test_order_value_is_per_transaction_without_outliers(spark):
    fact = sales(spark, [("a", 1, 20200101, 100), ("a", 1, 20200101, 200), ("b", 1, 20200102, 10001)])
    assert rows(kpis.average_order_value(fact, calendar(spark)), "transactions", "average_order_value") == [(1, 300.0)]


def test_campaigns_without_responses_come_first_with_no_value(spark):
    campaigns = spark.createDataFrame(
        [(1, "m1", "n", "t", "Email", None, None, 7, 100, "Completed"), (2, "m2", "n", "t", "Email", None, None, 7, 100, "Completed")],
        "campaign_key bigint, campaign_id string, campaign_name string, campaign_type string, channel string, start_date date, "
        "end_date date, duration_days int, budget int, campaign_status string").withColumn("budget", F.col("budget").cast("decimal(12,2)"))
    responses = spark.createDataFrame([(1, 9, 250, False, False, True)], "campaign_key bigint, customer_key bigint, v int, is_opened boolean, "
                                      "is_clicked boolean, is_converted boolean").withColumn("conversion_value", F.col("v").cast("decimal(10,2)"))
    got = analytics.campaign_roi(campaigns, responses).select("campaign_id", "conversions", "roi_percentage").collect()
    assert [tuple(r) for r in got] == [("m2", 0, None), ("m1", 1, 150.0)]


def test_twelve_months_before_a_month_end(spark):
    assert analytics.months_before(D(2024, 2, 29), 12) == D(2023, 2, 28)
    assert analytics.months_before(D(2001, 8, 1), 12) == D(2000, 8, 1)
    assert analytics.months_before(D(2001, 1, 31), 11) == D(2000, 2, 29)


def test_duplicate_and_completeness_rates(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", "y"), (None, "z")], "k string, v string")
    assert rows(kpis.duplicate_rate(df, ["k"])) == [(4, 1, 25.0)]
    assert rows(kpis.completeness(df, "t", ["k", "v"]), "column_name", "filled", "band") == [("k", 3, "FAILURE"), ("v", 3, "FAILURE")]
