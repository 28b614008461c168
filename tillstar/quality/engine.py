"""Running rules and keeping their results."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException, ArithmeticException, DateTimeException, NumberFormatException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.functions import clipped, percent, rounded, row_count
from tillstar.operators.keys import stored_once, with_keys
from tillstar.operators.rows import keep_latest, upsert
from tillstar.quality.rules import CATEGORIES, RULES, Rule, Tables
from tillstar.sources.tables import TableStore

log = logging.getLogger(__name__)

# Tasks in which the violations of one rule are trimmed before they meet.
SLICES = 64
SCORES = tuple(f"{name.lower()}_score" for name, _ in CATEGORIES)

# What a rule can do wrong by itself; anything else stops the run.
_RULE_FAULTS = (AnalysisException, ArithmeticException, DateTimeException, NumberFormatException)

_RULE_SCHEMA = (
    "rule_name string, rule_description string, category_name string, target_table string, target_column string, "
    "rule_type string, rule_parameters map<string,string>, severity string, failure_threshold double, is_active boolean, "
    "position int"
)
_VIOLATION_SCHEMA = (
    "rule_id bigint, table_name string, record_identifier string, column_name string, failed_value string, expected_value string"
)
_COUNT_SCHEMA = "rule_id bigint, total bigint, failed bigint, error string, duration_ms bigint"


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


# --- registry -------------------------------------------------------------------------------


def categories(spark: SparkSession) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(CATEGORIES, start=1)]
    return spark.createDataFrame(rows, "category_id int, category_name string, category_description string")


def register_rules(
    spark: SparkSession, cats: DataFrame, existing: DataFrame | None = None, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Upsert rule definitions by name. Known rules keep their id and activity flag, new ones
    are numbered after the highest id, rules not listed stay."""
    rows = [
        (r.name, r.description, r.category, r.table, r.column, r.rule_type, dict(r.parameters), r.severity,
         r.threshold, True, i)
        for i, r in enumerate(rules)
    ]
    listed = spark.createDataFrame(rows, _RULE_SCHEMA).join(
        F.broadcast(cats.select("category_id", "category_name")), "category_name"
    ).drop("category_name")
    if existing is None:
        base, known = F.lit(0), listed.withColumns(
            {"_id": F.lit(None).cast("bigint"), "_active": F.lit(None).cast("boolean")}
        )
    else:
        base = F.coalesce(existing.agg(F.max("rule_id")).scalar(), F.lit(0))
        ids = existing.select("rule_name", F.col("rule_id").alias("_id"), F.col("is_active").alias("_active"))
        known = listed.join(ids, "rule_name", "left")
    # the registry holds a handful of rules, so one task may number them
    order = Window.orderBy(F.col("_id").isNotNull(), "position")
    numbered = known.withColumn("rule_id", F.coalesce("_id", base + F.row_number().over(order)).cast("bigint"))
    fresh = numbered.withColumn("is_active", F.coalesce("_active", "is_active")).select(
        "rule_id", "rule_name", "rule_description", "category_id", "target_table", "target_column", "rule_type",
        "rule_parameters", "severity", "failure_threshold", "is_active",
    )
    return fresh if existing is None else upsert(existing, fresh, ["rule_name"]).select(*fresh.columns)


# --- execution ------------------------------------------------------------------------------


def count_violations(tables: Tables, rules: Sequence[tuple[int, Rule]], as_of: dt.date) -> DataFrame:
    """(rule_id, total, failed) for many rules.

    All rules of a table that look at single rows, at a peak or at groups of it are counted by one scan. Totals are those of the
    whole target table.
    """
    parts = []
    scans: dict[str, list[tuple[int, Rule]]] = {}
    for rule_id, rule in rules:
        if rule.grouped is not None:
            scans.setdefault(rule.grouped.table, []).append((rule_id, rule))
        elif rule.condition is not None or rule.peak is not None:
            scans.setdefault(rule.table, []).append((rule_id, rule))
        else:
            found = rule.violations(tables, as_of).agg(F.count(F.lit(1)).alias("failed"))
            parts.append(_counted(rule_id, tables[rule.table].agg(row_count()).scalar(), found))
    for table, own in scans.items():
        parts += _count_in_one_scan(tables, table, own, as_of)
    return _union(parts)


def _counted(rule_id: int, total: Column, found: DataFrame) -> DataFrame:
    return found.select(F.lit(rule_id).cast("bigint").alias("rule_id"), total.alias("total"), "failed")


def _count_in_one_scan(tables: Tables, table: str, rules: Sequence[tuple[int, Rule]], as_of: dt.date) -> list[DataFrame]:
    """Counts of rules from one scan of ``table``.

    Without groups this is one aggregate. With groups, a row is added to the group of each key in turn, combined with others before
    the shuffle; the first key's groups also carry what single rows and peaks need, so sums over them are
    those of the table. The groups, no more than there are key values, are stored and read by each rule.
    """
    single = [(i, r) for i, r in rules if r.grouped is None]
    grouped = [(i, r) for i, r in rules if r.grouped is not None]
    row = {"_rows": (F.lit(1).cast("bigint"), F.sum)}
    for i, r in single:
        if r.condition is not None:
            row[f"_{i}"] = (F.when(r.predicate(as_of), 1).otherwise(0).cast("bigint"), F.sum)
        else:
            row[f"_{i}"] = (F.expr(r.peak), F.max)
    df = tables[table]
    keys = list(dict.fromkeys(r.grouped.key for _, r in grouped))
    if keys:
        sums = {(k, n): f"_sum{at}_{n}" for at, k in enumerate(keys) for _, r in grouped if r.grouped.key == k for n in r.grouped.sums}
        exact = {name: F.expr(next(r.grouped.sums[n] for _, r in grouped if r.grouped.key == k and n in r.grouped.sums))
                 for (k, n), name in sums.items()}
        # one value a column for the scan: conditions are evaluated once, not once for each key
        values = df.select(
            *[F.col(k).cast("bigint").alias(f"_key{at}") for at, k in enumerate(keys)],
            *[c.alias(n) for n, (c, _) in row.items()], *[c.alias(n) for n, c in exact.items()])
        types = {f.name: f.dataType for f in values.schema}

        def arm(at: int) -> Column:
            own = {n for (k, _), n in sums.items() if k == keys[at]} | ({*row} if at == 0 else {"_rows"})
            cells = [(F.col(n) if n in own else F.lit(None).cast(types[n])).alias(n) for n in (*row, *exact)]
            return F.struct(F.lit(at).alias("_of"), F.col(f"_key{at}").alias("_key"), *cells)

        counted = values.select(F.inline(F.array(*[arm(at) for at in range(len(keys))]))).groupBy("_of", "_key").agg(
            *[how(n).alias(n) for n, (_, how) in row.items()], *[F.sum(n).cast("decimal(28,2)").alias(n) for n in exact])
        groups = stored_once(counted, "rule-groups")
        whole = groups.filter("_of = 0").agg(*[
            (F.coalesce(F.sum(n), F.lit(0)) if how is F.sum else how(n)).alias(n) for n, (_, how) in row.items()])
    else:
        whole = df.agg(*[(F.coalesce(how(c), F.lit(0)) if how is F.sum else how(c)).alias(n) for n, (c, how) in row.items()])

    def failed(i: int, r: Rule) -> Column:
        if r.condition is not None:
            return F.col(f"_{i}")
        return F.when(F.coalesce(r.peak_is_bad(F.col(f"_{i}"), as_of), F.lit(False)), 1).otherwise(0).cast("bigint")

    parts = []
    if single:
        cells = [F.struct(F.lit(i).cast("bigint").alias("rule_id"), F.col("_rows").alias("total"), failed(i, r).alias("failed"))
                 for i, r in single]
        parts.append(whole.select(F.inline(F.array(*cells))))
    for i, r in grouped:
        at = keys.index(r.grouped.key)
        mine = groups.filter(F.col("_of") == at).select(
            F.col("_key").alias("key"), F.col("_rows").alias("rows"),
            *[F.col(sums[r.grouped.key, n]).alias(n) for n in r.grouped.sums])
        total = (whole.select("_rows") if r.table == table else tables[r.table].agg(row_count())).scalar()
        parts.append(_counted(i, total, r.grouped.judge(mine, tables)))
    return parts


def _measured(spark: SparkSession, tables: Tables, rules: Sequence[tuple[int, Rule]], as_of: dt.date) -> list[tuple]:
    """Counts as driver rows, one per rule, with the run time of the job they were counted in. If
    the joint job fails by a rule's fault, the rules are run one by one, so that a broken rule ends as an error of its own."""
    began = time.monotonic()
    try:
        rows = count_violations(tables, rules, as_of).collect()
        spent = int((time.monotonic() - began) * 1000)
        return [(r["rule_id"], r["total"], r["failed"], None, spent) for r in rows]
    except Exception as failure:
        if len(rules) > 1 and not isinstance(failure, _RULE_FAULTS):
            raise  # not the fault of a rule
        if len(rules) == 1:
            log.error("rule %s failed: %s", rules[0][1].name, failure)
            return [(rules[0][0], 0, 0, str(failure), 0)]
        return [row for one in rules for row in _measured(spark, tables, [one], as_of)]


def grade(counted: DataFrame) -> DataFrame:
    """Status and message from counts and threshold. The threshold is compared with the
    unrounded percentage."""
    failed, total, limit = F.col("failed"), F.col("total"), F.col("failure_threshold")
    share = F.coalesce(percent(failed, total, None), F.lit(0.0))
    limit_text = F.concat(F.lit("threshold ("), limit.cast("string"), F.lit("%)"))
    status = (
        F.when(F.col("error").isNotNull(), "ERROR").when(failed == 0, "PASSED").when(share <= limit, "WARNING")
        .otherwise("FAILED")
    )
    message = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(failed == 0, "All records passed validation")
        .when(share <= limit, F.concat(failed.cast("string"), F.lit(" violations found but within "), limit_text))
        .otherwise(F.concat(failed.cast("string"), F.lit(" violations exceed "), limit_text))
    )
    return counted.select(
        "rule_id", total.alias("total_records_checked"), failed.alias("failed_records"),
        (total - failed).alias("passed_records"), rounded(share).alias("failure_percentage"),
        status.alias("test_status"), message.alias("test_message"), F.col("duration_ms").alias("execution_duration_ms"),
    )


def run_rules(
    spark: SparkSession, tables: Tables, registry: DataFrame, as_of: dt.date, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Results of all active rules that have a definition."""
    active = registry.filter("is_active").select("rule_id", "rule_name").collect()
    by_name = {r.name: r for r in rules}
    due = [(row["rule_id"], by_name[row["rule_name"]]) for row in active if row["rule_name"] in by_name]
    counted = spark.createDataFrame(_measured(spark, tables, due, as_of), _COUNT_SCHEMA)
    return grade(counted.join(F.broadcast(registry.select("rule_id", "failure_threshold")), "rule_id"))


def execute_rule(
    spark: SparkSession, tables: Tables, rule: Rule, rule_id: int, as_of: dt.date
) -> tuple[DataFrame, DataFrame | None]:
    """Result and violations of one rule; a rule that cannot run gives an error result."""
    measured = _measured(spark, tables, [(rule_id, rule)], as_of)
    counted = spark.createDataFrame(measured, _COUNT_SCHEMA).withColumn("failure_threshold", F.lit(rule.threshold))
    return grade(counted), rule.violations(tables, as_of) if measured[0][3] is None else None


def summary(results: DataFrame) -> DataFrame:
    """Rules run and rules per status."""
    status = F.col("test_status")
    return results.agg(
        row_count().alias("total_rules"),
        *[F.count_if(status == s).alias(s.lower()) for s in ("PASSED", "FAILED", "WARNING", "ERROR")],
    )


def violation_records(tables: Tables, rules: Sequence[tuple[int, Rule]], as_of: dt.date) -> DataFrame:
    """Violations of many rules with their rule id; single-row rules share one scan per table."""
    parts = []
    by_table: dict[str, list[tuple[int, Rule]]] = {}
    for rule_id, rule in rules:
        if rule.condition is not None:
            by_table.setdefault(rule.table, []).append((rule_id, rule))
        else:
            parts.append(rule.violations(tables, as_of).select(
                F.lit(rule_id).cast("bigint").alias("rule_id"), F.lit(rule.table).alias("table_name"), "*"
            ))
    for table, group in by_table.items():
        found = F.array(*[
            F.when(
                rule.predicate(as_of), F.struct(F.lit(i).cast("bigint").alias("rule_id"), rule.as_struct().alias("v"))
            )
            for i, rule in group
        ])
        hits = tables[table].select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("hit"))
        parts.append(hits.select("hit.rule_id", F.lit(table).alias("table_name"), "hit.v.*"))
    return _union(parts) if parts else SparkSession.active().createDataFrame([], _VIOLATION_SCHEMA)


def sample_exceptions(violations: DataFrame, limit: int | None = None, text_limit: int | None = None) -> DataFrame:
    """Violations ready to store: all, or the first ``limit`` of each rule in order of their identifier.

    Missing values are stored as the text ``None``; the hash covers the full value.
    """

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("None"))

    kept = violations
    if limit is not None:
        order = ("record_identifier", "failed_value")
        # trimmed in many tasks before the tasks of a rule meet in one
        slices = Window.partitionBy("rule_id", "_slice").orderBy(*order)
        kept = (
            kept.withColumn("_slice", F.pmod(F.xxhash64("record_identifier", "failed_value"), F.lit(SLICES)))
            .withColumn("_rank", F.row_number().over(slices)).filter(F.col("_rank") <= limit)
            .withColumn("_rank", F.row_number().over(Window.partitionBy("rule_id").orderBy(*order)))
            .filter(F.col("_rank") <= limit)
        )

    def short(name: str) -> Column:
        return text(name) if text_limit is None else clipped(text(name), text_limit)

    digest = F.md5(F.concat_ws("_", F.col("rule_id").cast("string"), text("record_identifier"), text("column_name"), text("failed_value")))
    return kept.select(
        "rule_id", "table_name", "record_identifier", "column_name",
        short("failed_value").alias("failed_value"), short("expected_value").alias("expected_value"), digest.alias("exception_hash"),
    )


def scorecard(
    results: DataFrame, registry: DataFrame, cats: DataFrame, report_date: dt.date, period: str = "DAILY"
) -> DataFrame:
    """One row of scores for a day, from the latest run of each rule on that day.

    A category scores the share of checked records that passed, 100 when nothing was
    checked; the overall score is the plain mean of the seven categories.
    """
    day = results.filter(F.to_date("execution_date") == F.lit(report_date))
    latest = keep_latest(day, ["rule_id"], [F.col("execution_date").desc(), F.col("result_id").desc()])
    known = latest.join(F.broadcast(registry.select("rule_id", "category_id")), "rule_id").join(
        F.broadcast(cats.select("category_id", "category_name")), "category_id"
    )
    checked, failed, status = F.col("total_records_checked"), F.col("failed_records"), F.col("test_status")

    def score(name: str) -> Column:
        mine = F.col("category_name") == name
        total = F.sum(F.when(mine, checked))
        return F.coalesce(percent(F.sum(F.when(mine, checked - failed)), total), F.lit(100.0))

    row = known.agg(
        row_count().alias("total_rules_executed"),
        F.count_if(status == "PASSED").alias("rules_passed"),
        F.count_if(status == "FAILED").alias("rules_failed"),
        F.count_if(status == "WARNING").alias("rules_warning"),
        *[score(name).alias(column) for (name, _), column in zip(CATEGORIES, SCORES)],
        F.sum(checked).alias("total_records_checked"),
        F.sum(failed).alias("total_failed_records"),
    ).filter("total_rules_executed > 0")
    overall = rounded(sum((F.col(s) for s in SCORES[1:]), F.col(SCORES[0])) / F.lit(float(len(SCORES))))
    return row.select(
        F.lit(report_date).alias("report_date"), F.lit(period).alias("report_period"), "total_rules_executed",
        "rules_passed", "rules_failed", "rules_warning", overall.alias("overall_quality_score"), *SCORES,
        "total_records_checked", "total_failed_records",
    )


def quality_run(
    store: TableStore, tables: Tables, run_at: dt.datetime, as_of: dt.date | None = None,
    rules: Sequence[Rule] = RULES, period: str = "DAILY", exception_limit: int | None = None, text_limit: int | None = None,
) -> DataFrame:
    """Register rules, run them, and store results, exceptions and the day's scorecard.

    All violations are stored whole, unless ``exception_limit`` (rows of a rule) or ``text_limit``
    (letters of a value) say otherwise. Returns the summary by status."""
    spark, as_of = store.spark, as_of or run_at.date()
    store.replace(categories(spark), "dq_rule_categories")
    cats = store.read("dq_rule_categories")
    known = store.read("dq_rules") if store.exists("dq_rules") else None
    store.replace(register_rules(spark, cats, known, rules).coalesce(1), "dq_rules")
    registry = store.read("dq_rules")

    results = run_rules(spark, tables, registry, as_of, rules)
    last = store.read("dq_test_results").agg(F.max("result_id")).first()[0] if store.exists("dq_test_results") else 0
    # one row per rule: numbering them in one task is fine
    numbered = results.withColumns(
        {
            "result_id": (F.row_number().over(Window.orderBy("rule_id")) + F.lit(last)).cast("bigint"),
            "execution_date": F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz"),
        }
    )
    store.append(numbered, "dq_test_results")
    stored = store.read("dq_test_results").filter(F.col("result_id") > last)

    ids = {row["rule_name"]: row["rule_id"] for row in registry.select("rule_name", "rule_id").collect()}
    # rules that ran, neither switched off nor ended in an error, and found something: the others have no violations to look for
    hit = {row["rule_id"] for row in stored.filter("test_status <> 'ERROR' and failed_records > 0").select("rule_id").collect()}
    due = [(ids[r.name], r) for r in rules if ids[r.name] in hit]
    sample = sample_exceptions(violation_records(tables, due, as_of), exception_limit, text_limit).join(
        F.broadcast(stored.select("rule_id", "result_id")), "rule_id"
    )
    first = store.read("dq_exceptions").agg(F.max("exception_id")).first()[0] if store.exists("dq_exceptions") else 0
    keyed = with_keys(sample, "exception_id", ["rule_id", "record_identifier", "failed_value"], (first or 0) + 1)
    store.append(
        keyed.withColumns(
            {
                "detected_date": F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz"),
                "resolution_status": F.lit("OPEN"),
            }
        ),
        "dq_exceptions",
    )
    card = scorecard(store.read("dq_test_results"), registry, cats, run_at.date(), period)
    if store.exists("dq_scorecards"):
        card = upsert(store.read("dq_scorecards"), card, ["report_date", "report_period"])
    store.replace(card.coalesce(1), "dq_scorecards")
    return summary(stored)
