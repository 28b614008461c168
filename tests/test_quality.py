import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from tests.conftest import rows
from tillstar.quality import engine, reports
from tillstar.quality.rules import RULES, Rule, not_null, row_check

DAY = dt.date(2001, 8, 1)


def about(name):
    return dict(name=name, description="", category="Accuracy", severity="INFO", threshold=0.0)


def test_under_age_expired_versions_are_reported(spark):
    age = RULES[3]
    dim = spark.createDataFrame([(1, 10, False), (2, 130, False), (3, 130, True), (4, 30, True)], "customer_key bigint, age int, is_current boolean")
    assert rows(age.violations({"dim_customer": dim}, DAY), "record_identifier", "failed_value") == [("1", "10"), ("3", "130")]


def test_status_follows_the_unrounded_percentage(spark):
    counted = spark.createDataFrame(
        [(1, 1000, 0, None, 1, 0.0), (2, 100000, 1004, None, 1, 1.0), (3, 100, 1, None, 1, 1.0), (4, 0, 0, "boom", 0, 1.0)],
        "rule_id bigint, total bigint, failed bigint, error string, duration_ms bigint, failure_threshold double",
    )
    got = {r["rule_id"]: r for r in engine.grade(counted).collect()}
    assert [got[i]["test_status"] for i in (1, 2, 3, 4)] == ["PASSED", "FAILED", "WARNING", "ERROR"]
    assert got[2]["failure_percentage"] == 1.0
    assert got[3]["test_message"] == "1 violations found but within threshold (1.0%)"
    assert got[2]["test_message"] == "1004 violations exceed threshold (1.0%)"


def test_a_broken_rule_becomes_an_error_and_the_others_run(spark):
    tables = {"t": spark.createDataFrame([(1, None), (2, "x")], "k bigint, v string")}
    rules = (not_null("t", "k", "v", **about("good")), row_check("t", "k", "nope", "nope > 1", "nope", "''", **about("bad")))
    registry = engine.register_rules(spark, engine.categories(spark), None, rules)
    results = engine.run_rules(spark, tables, registry, DAY, rules)
    assert rows(results, "rule_id", "total_records_checked", "failed_records", "test_status") == [(1, 2, 1, "FAILED"), (2, 0, 0, "ERROR")]
    assert rows(engine.summary(results)) == [(2, 0, 1, 0, 1)]


def test_inactive_rules_are_skipped_and_keep_their_id(spark):
    cats = engine.categories(spark)
    first = engine.register_rules(spark, cats, None, RULES[:3])
    off = first.withColumn("is_active", F.col("rule_id") != 2)
    again = engine.register_rules(spark, cats, off, (RULES[4], replace(RULES[1], threshold=3.0)))
    assert rows(again, "rule_id", "rule_name", "is_active", "failure_threshold") == [
        (1, RULES[0].name, True, 5.0), (2, RULES[1].name, False, 3.0), (3, RULES[2].name, True, 0.0), (4, RULES[4].name, True, 0.1)]


def test_stored_exceptions_are_cut_per_rule_and_trimmed_before_the_shuffle(spark):
    many = spark.range(3000).select(
        (F.col("id") % 2).alias("rule_id"), F.lit("t").alias("table_name"), F.col("id").cast("string").alias("record_identifier"),
        F.lit("c").alias("column_name"), F.lit(None).cast("string").alias("failed_value"), F.lit("y" * 2000).alias("expected_value"))
    kept = engine.sample_exceptions(many, 1000, 1000)
    assert rows(kept.groupBy("rule_id").count()) == [(0, 1000), (1, 1000)]
    one = kept.first()
    assert one["failed_value"] == "None" and len(one["expected_value"]) == 1000
    assert kept._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 4
    assert engine.sample_exceptions(many).count() == 3000


def test_scorecard_counts_the_latest_run_of_a_rule(spark):
    cats = engine.categories(spark)
    registry = engine.register_rules(spark, cats)
    t = [dt.datetime(2001, 8, 1, h) for h in (8, 9)]
    results = spark.createDataFrame(
        [(1, 1, t[0], 100, 50, 50, "FAILED"), (2, 1, t[1], 100, 10, 90, "WARNING"), (3, 4, t[0], 0, 0, 0, "ERROR")],
        "result_id bigint, rule_id bigint, execution_date timestamp_ntz, total_records_checked bigint, failed_records bigint, "
        "passed_records bigint, test_status string")
    card = engine.scorecard(results, registry, cats, DAY).first()
    assert (card["completeness_score"], card["accuracy_score"], card["overall_quality_score"]) == (90.0, 100.0, 98.57)
    assert (card["total_rules_executed"], card["rules_failed"], card["rules_warning"], card["total_failed_records"]) == (2, 0, 1, 10)
    assert engine.scorecard(results, registry, cats, dt.date(2001, 8, 2)).count() == 0


def test_runs_accumulate_and_the_scorecard_of_a_day_is_replaced(ctx, store):
    for hour in (8, 9):
        engine.quality_run(store, ctx.tables, dt.datetime(2001, 8, 1, hour))
    results = store.read("dq_test_results")
    assert sorted(r["result_id"] for r in results.collect()) == list(range(1, 31))
    assert store.read("dq_scorecards").count() == 1
    ids = sorted(r["exception_id"] for r in store.read("dq_exceptions").collect())
    assert ids == list(range(1, len(ids) + 1))


def test_advice(spark):
    cards = spark.createDataFrame([("a", 1, 94.0, 85.0), ("b", 0, 99.0, 96.0), ("c", 0, 99.0, 50.0)],
                                  "report_date string, rules_failed int, completeness_score double, overall_quality_score double"
                                  ).withColumn("report_period", F.lit("DAILY"))
    got = rows(reports.recommendations(cards), "report_date", "position", "recommendation")
    assert got == [("a", 0, reports.ADVICE_FAILED), ("a", 1, reports.ADVICE_INCOMPLETE), ("a", 2, reports.ADVICE_GOOD),
                   ("b", 0, reports.ADVICE_EXCELLENT), ("c", 0, reports.ADVICE_POOR)]


class Seen(dict):
    """Tables that count how often each is asked for."""

    def __init__(self, tables):
        super().__init__({n: tables[n] for n in ("dim_customer", "dim_product", "dim_date", "fact_transactions")})
        self.asked = []

    def __getitem__(self, name):
        self.asked.append(name)
        return super().__getitem__(name)


def test_all_rules_of_the_fact_share_one_scan_and_count_as_one_by_one(ctx):
    due = list(enumerate(RULES, start=1))
    for as_of in (DAY, dt.date(1994, 1, 1), dt.date(2040, 1, 1)):
        tables = Seen(ctx.tables)
        together = engine.count_violations(tables, due, as_of)
        assert tables.asked.count("fact_transactions") == 1
        got = {r["rule_id"]: (r["total"], r["failed"]) for r in together.collect()}
        assert len(got) == 15
        for i, rule in due:
            assert got[i] == (ctx[rule.table].count(), rule.violations(ctx.tables, as_of).count()), rule.name
        alone = {r["rule_id"]: (r["total"], r["failed"]) for one in due for r in engine.count_violations(tables, [one], as_of).collect()}
        assert alone == got


def test_missing_keys_and_empty_facts_in_the_shared_scan(spark, ctx):
    fact = ctx["fact_transactions"]
    damaged = fact.withColumn("customer_key", F.when(F.col("transaction_key") % 3 > 0, F.col("customer_key"))).withColumn(
        "product_key", F.when(F.col("transaction_key") % 2 > 0, F.lit(-5)).otherwise(F.col("product_key")))
    for rows_of in (damaged, fact.limit(0)):
        tables = {n: ctx[n] for n in ("dim_customer", "dim_product", "dim_date")} | {"fact_transactions": rows_of}
        got = {r["rule_id"]: (r["total"], r["failed"]) for r in engine.count_violations(tables, list(enumerate(RULES, 1)), DAY).collect()}
        n = rows_of.count()
        assert got[11] == (n, rows_of.filter("customer_key is null").count()) and got[12] == (n, rows_of.filter("product_key = -5").count())
        assert got[9][1] == RULES[8].violations(tables, DAY).count() and got[5][0] == n


def test_violations_are_looked_for_where_rules_failed_only(spark, store):
    """A rule without failures is not run a second time for its violations; no failures at all leave an empty table."""
    def find(tables, as_of):
        raise AssertionError("asked for the violations of a rule that found none")

    def peak(limit):
        return Rule(table="t", column="v", rule_type="custom_sql", find=find, peak="v", peak_is_bad=lambda top, as_of: top > limit,
                    **about("peak"))

    tables = {"t": spark.createDataFrame([(1, 5), (2, -1), (3, -2)], "k bigint, v int")}
    engine.quality_run(store, tables, dt.datetime(2001, 8, 1, 8), rules=[peak(9)])
    assert store.read("dq_exceptions").count() == 0
    low = row_check("t", "k", "v", "v < 0", "v", "'>= 0'", **about("low"))
    engine.quality_run(store, tables, dt.datetime(2001, 8, 1, 9), rules=[peak(9), low])
    assert rows(store.read("dq_exceptions"), "exception_id", "record_identifier", "failed_value") == [(1, "2", "-1"), (2, "3", "-2")]
    assert store.read("dq_test_results").count() == 3
