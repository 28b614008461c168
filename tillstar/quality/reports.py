"""Views and reports over stored quality results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import percent, score_band
from tillstar.quality.engine import SCORES


def _named(df: DataFrame, rules: DataFrame, cats: DataFrame, *columns: str) -> DataFrame:
    """Rows with the name, the given columns, and the category of their rule. The registry
    holds a handful of rows."""
    known = rules.join(F.broadcast(cats.select("category_id", "category_name")), "category_id")
    return df.join(F.broadcast(known.select("rule_id", "rule_name", "category_name", *columns)), "rule_id")


def active_rules(rules: DataFrame, cats: DataFrame, results: DataFrame) -> DataFrame:
    """Active rules with how often and when they last ran."""
    runs = results.groupBy("rule_id").agg(
        F.count("result_id").alias("_runs"), F.max("execution_date").alias("last_execution")
    )
    return (
        rules.filter("is_active")
        .join(cats.select("category_id", "category_name"), "category_id", "left")
        .join(runs, "rule_id", "left")
        .select(
            "rule_id", "rule_name", "category_name", "target_table", "target_column", "severity", "is_active",
            F.coalesce("_runs", F.lit(0)).alias("execution_count"), "last_execution",
        )
    )


def latest_scores(scorecards: DataFrame) -> DataFrame:
    """All scorecards of the most recent report date."""
    newest = scorecards.agg(F.max("report_date")).scalar()
    return scorecards.filter(F.col("report_date") == newest).select(
        "report_date", "report_period", "overall_quality_score", *SCORES, "total_rules_executed", "rules_passed",
        "rules_failed", "rules_warning",
    )


def open_exceptions(exceptions: DataFrame, rules: DataFrame, cats: DataFrame, as_of: dt.date) -> DataFrame:
    pending = exceptions.filter(F.col("resolution_status").isin("OPEN", "IN_PROGRESS"))
    return (
        _named(pending, rules, cats)
        .select(
            "exception_id", "rule_name", "category_name", "table_name", "column_name", "resolution_status",
            "detected_date", F.date_diff(F.lit(as_of), F.to_date("detected_date")).alias("days_open"),
        )
        .orderBy("detected_date", "exception_id")
    )


def latest_scorecard(scorecards: DataFrame) -> DataFrame:
    return scorecards.orderBy(F.col("report_date").desc(), "report_period").limit(1)


def score_trend(scorecards: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    recent = scorecards.filter(F.col("report_date") >= F.lit(as_of - dt.timedelta(days=days)))
    return recent.select(
        "report_date", "overall_quality_score", *SCORES, "rules_passed", "rules_warning", "rules_failed"
    ).orderBy("report_date")


def recent_results(results: DataFrame, rules: DataFrame, cats: DataFrame, as_of: dt.date, days: int = 1) -> DataFrame:
    since = dt.datetime.combine(as_of - dt.timedelta(days=days), dt.time())
    recent = results.filter(F.col("execution_date") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    return (
        _named(recent, rules, cats, "rule_description", "target_table", "severity")
        .select(
            "rule_name", "rule_description", "category_name", "target_table", "severity", "test_status",
            "total_records_checked", "failed_records", "passed_records", "failure_percentage", "test_message",
            "execution_date", "execution_duration_ms",
        )
        .orderBy(F.col("execution_date").desc(), "category_name", "rule_name")
    )


def top_exceptions(
    exceptions: DataFrame, rules: DataFrame, cats: DataFrame, as_of: dt.date, limit: int = 100, days: int = 7
) -> DataFrame:
    since = dt.datetime.combine(as_of - dt.timedelta(days=days), dt.time())
    recent = exceptions.filter(F.col("detected_date") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    newest = recent.orderBy(F.col("detected_date").desc(), "exception_id").limit(limit)
    return _named(newest, rules, cats).select(
        "rule_name", "category_name", "table_name", "record_identifier", "column_name", "failed_value",
        "expected_value", "detected_date",
    )


def headline(scorecards: DataFrame) -> DataFrame:
    """Score band, success rate of rules and failure rate of records per scorecard."""
    return scorecards.select(
        "report_date", "report_period", "overall_quality_score",
        score_band("overall_quality_score").alias("score_band"),
        percent("rules_passed", "total_rules_executed").alias("pass_rate"),
        percent("total_failed_records", "total_records_checked").alias("failure_rate"),
    )


# The advice texts.
ADVICE_FAILED = "IMMEDIATE ACTION: Review and remediate failed validation rules"
ADVICE_INCOMPLETE = "Address data completeness gaps in source systems"
ADVICE_EXCELLENT = "Data quality is excellent - maintain current processes"
ADVICE_GOOD = "Data quality is good - minor improvements needed"
ADVICE_POOR = "Data quality needs improvement - implement corrective actions"


def recommendations(scorecards: DataFrame) -> DataFrame:
    """Advice per scorecard, in order of urgency."""
    overall = F.col("overall_quality_score")
    advice = F.array(
        F.when(F.col("rules_failed") > 0, F.lit(ADVICE_FAILED)),
        F.when(F.col("completeness_score") < 95, F.lit(ADVICE_INCOMPLETE)),
        F.when(overall >= 95, F.lit(ADVICE_EXCELLENT)).when(overall >= 80, F.lit(ADVICE_GOOD)).otherwise(F.lit(ADVICE_POOR)),
    )
    return scorecards.select(
        "report_date", "report_period", F.posexplode(F.filter(advice, lambda x: x.isNotNull())).alias("position", "recommendation")
    )
