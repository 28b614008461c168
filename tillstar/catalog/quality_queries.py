"""Rules, rule execution, scorecards and quality reports."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.catalog.base import SALES_AS_OF, Context, define, query, sql_percent, sql_round
from tillstar.catalog.fact_queries import damaged
from tillstar.quality import engine, reports
from tillstar.quality.rules import CATEGORIES, EMAIL_PATTERN, RULES
from tillstar.sources.tables import TableStore

RUNS = (dt.datetime(2001, 7, 31, 8, 0), dt.datetime(2001, 8, 1, 8, 0))

# --- the rules in SQL -----------------------------------------------------------------------


def _rule_sql(rule_id: int, as_of: dt.date, customer: str, product: str, fact: str) -> str:
    """Violations of one rule, written independently of the rule definitions."""

    def rows(table: str, key: str, column: str, failed: str, expected: str, where: str) -> str:
        return (f"select cast({key} as varchar) as record_identifier, '{column}' as column_name, "
                f"{failed} as failed_value, {expected} as expected_value from {table} where {where}")

    none = "cast(null as varchar)"
    return {
        1: rows(customer, "customer_key", "email", none, "'NOT NULL'",
                "email is null and is_current and account_status = 'Active'"),
        2: rows(customer, "customer_key", "phone_number", none, "'NOT NULL'", "phone_number is null and is_current"),
        3: rows(product, "product_key", "product_category", none, "'NOT NULL'", "product_category is null"),
        4: rows(customer, "customer_key", "age", "cast(age as varchar)", "'18-120'",
                "age < 18 or age > 120 and is_current"),
        5: rows(fact, "transaction_key", "net_amount", "cast(net_amount as varchar)", "'> 0'", "net_amount <= 0"),
        6: rows(product, "product_key", "retail_price", "cast(retail_price as varchar)", "'> unit_cost'",
                "retail_price <= unit_cost"),
        7: f"""select cast(min(customer_key) as varchar) as record_identifier, 'customer_id' as column_name,
                      customer_id as failed_value, 'UNIQUE' as expected_value
               from {customer} where is_current group by customer_id having count(*) > 1""",
        8: f"""select cast(min(product_key) as varchar) as record_identifier, 'product_id' as column_name,
                      product_id as failed_value, 'UNIQUE' as expected_value
               from {product} group by product_id having count(*) > 1""",
        9: f"""select cast(c.customer_key as varchar) as record_identifier, 'lifetime_value' as column_name,
                      cast(c.lifetime_value as varchar) as failed_value,
                      cast(cast(coalesce(s.net, 0) as decimal(28,2)) as varchar) as expected_value
               from {customer} c left join (select customer_key, sum(net_amount) as net from {fact} group by 1) s
                 on c.customer_key = s.customer_key
               where c.is_current and abs(c.lifetime_value - coalesce(s.net, 0)) > 0.01""",
        10: rows(fact, "transaction_key", "line_total", "cast(line_total as varchar)",
                 "cast(cast(quantity * unit_price as decimal(18,2)) as varchar)",
                 "abs(line_total - quantity * unit_price) > 0.01"),
        11: rows(f"{fact} f", "transaction_key", "customer_key", "cast(customer_key as varchar)", "'VALID FK'",
                 f"not exists (select 1 from {customer} c where c.customer_key = f.customer_key)"),
        12: rows(f"{fact} f", "transaction_key", "product_key", "cast(product_key as varchar)", "'VALID FK'",
                 f"not exists (select 1 from {product} p where p.product_key = f.product_key)"),
        13: rows(customer, "customer_key", "email", "email", "'valid email format'",
                 f"email is not null and not regexp_matches(email, '{EMAIL_PATTERN}') and is_current"),
        14: rows(f"{fact} f join dim_date d on f.transaction_date_key = d.date_key", "transaction_key",
                 "transaction_date_key", "cast(transaction_date_key as varchar)", "'<= TODAY'",
                 f"d.date_actual > date '{as_of}'"),
        15: f"""select '0' as record_identifier, 'transaction_date' as column_name,
                       cast(max(d.date_actual) as varchar) as failed_value,
                       cast(date '{as_of}' - 7 as varchar) as expected_value
                from {fact} f join dim_date d on f.transaction_date_key = d.date_key
                having max(d.date_actual) < date '{as_of}' - 7""",
    }[rule_id]


# The rules are also shown on a warehouse with planted defects, so that each finds something.
define("customer_damaged", """
    select * replace (case when customer_key % 97 = 0 then cast(lifetime_value + 1 as decimal(28,2))
                           else lifetime_value end as lifetime_value)
    from dim_customer
    union all
    select * from dim_customer where is_current and customer_key % 200 = 0""")
define("product_damaged", """
    select * replace (case when product_key % 50 = 0 then null else product_category end as product_category,
                      case when product_key % 60 = 0 then unit_cost else retail_price end as retail_price)
    from dim_product
    union all
    select * from dim_product where product_key % 80 = 0""")
define("fact_defects", """
    select * replace (case when transaction_key % 70 = 0 then cast(-net_amount as decimal(12,2)) else net_amount end as net_amount)
    from fact_damaged""")


def defective(c: Context) -> Mapping[str, DataFrame]:
    tables = damaged(c)
    customer, product, fact = tables["dim_customer"], tables["dim_product"], tables["fact_transactions"]
    worn = customer.withColumn(
        "lifetime_value",
        F.when(F.col("customer_key") % 97 == 0, (F.col("lifetime_value") + 1).cast("decimal(28,2)"))
        .otherwise(F.col("lifetime_value")),
    )
    bare = product.withColumns(
        {
            "product_category": F.when(F.col("product_key") % 50 != 0, F.col("product_category")),
            "retail_price": F.when(F.col("product_key") % 60 == 0, F.col("unit_cost")).otherwise(F.col("retail_price")),
        }
    )
    negative = F.when(F.col("transaction_key") % 70 == 0, (-F.col("net_amount")).cast("decimal(12,2)"))
    return ChainMap({
        "dim_customer": worn.union(customer.filter("is_current and customer_key % 200 = 0")),
        "dim_product": bare.union(product.filter("product_key % 80 = 0")),
        "fact_transactions": fact.withColumn("net_amount", negative.otherwise(F.col("net_amount"))),
    }, tables)


_RULE_DAY = {14: dt.date(2001, 6, 1), 15: dt.date(2001, 12, 1)}
_SHORT = ("email_not_null", "phone_not_null", "category_not_null", "age_range", "amount_positive", "price_above_cost",
          "customer_unique", "product_unique", "lifetime_value", "line_total", "customer_fk", "product_fk",
          "email_format", "future_date", "recent_data")


def _register_rule(rule_id: int) -> None:
    as_of = _RULE_DAY.get(rule_id, SALES_AS_OF)
    text = _rule_sql(rule_id, as_of, "customer_damaged", "product_damaged", "fact_defects")

    @query(f"R{rule_id:02d}_{_SHORT[rule_id - 1]}", text)
    def _(c: Context) -> DataFrame:
        return RULES[rule_id - 1].violations(defective(c), as_of)


for _id in range(1, len(RULES) + 1):
    _register_rule(_id)


# --- stored results -------------------------------------------------------------------------


def dq(c: Context) -> dict[str, DataFrame]:
    """The quality tables after two runs on consecutive days."""
    store = TableStore(c.spark, f"{c.root}/quality")

    def build() -> None:
        for run_at in RUNS:
            engine.quality_run(store, c.tables, run_at, exception_limit=1000, text_limit=1000)

    c.once("quality", build)
    names = ("dq_rule_categories", "dq_rules", "dq_test_results", "dq_exceptions", "dq_scorecards")
    return {n: store.read(n) for n in names}


def _values(rows: list[tuple]) -> str:
    def lit(x) -> str:
        return str(x) if not isinstance(x, str) else "'" + x.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)


_CATEGORY_ID = {name: i for i, (name, _) in enumerate(CATEGORIES, start=1)}
define("dq_rule_categories", "select * from (values "
       + _values([(i, n, d) for i, (n, d) in enumerate(CATEGORIES, start=1)])
       + ") t(category_id, category_name, category_description)")
define("dq_rules", "select cast(rule_id as bigint) as rule_id, * exclude (rule_id) replace (cast(failure_threshold as double) as failure_threshold), true as is_active from (values "
       + _values([(i, r.name, r.description, _CATEGORY_ID[r.category], r.table, r.column, r.rule_type, r.severity, r.threshold)
                  for i, r in enumerate(RULES, start=1)])
       + ") t(rule_id, rule_name, rule_description, category_id, target_table, target_column, rule_type, severity, failure_threshold)")


def _all_violations(run: int) -> str:
    as_of = RUNS[run].date()
    return " union all ".join(
        f"select cast({i} as bigint) as rule_id, '{RULES[i - 1].table}' as table_name, v.* from "
        f"({_rule_sql(i, as_of, 'dim_customer', 'dim_product', 'fact_transactions')}) v"
        for i in range(1, len(RULES) + 1)
    )


for _run in range(len(RUNS)):
    define(f"violations_{_run}", _all_violations(_run))
define("table_sizes", " union all ".join(
    f"select '{t}' as target_table, count(*) as total from {t}" for t in ("dim_customer", "dim_product", "fact_transactions")))
define("rule_counts", " union all ".join(
    f"""select {_run} as run, timestamp '{RUNS[_run]}' as execution_date, r.*, z.total, coalesce(v.failed, 0) as failed
        from dq_rules r join table_sizes z on r.target_table = z.target_table
        left join (select rule_id, count(*) as failed from violations_{_run} group by rule_id) v on r.rule_id = v.rule_id"""
    for _run in range(len(RUNS))))
define("dq_test_results", f"""
    select 15 * run + rule_id as result_id, rule_id, execution_date, total as total_records_checked,
           failed as failed_records, total - failed as passed_records,
           coalesce({sql_percent('failed', 'total')}, 0e0) as failure_percentage,
           case when failed = 0 then 'PASSED'
                when failed * 100e0 / total <= failure_threshold then 'WARNING' else 'FAILED' end as test_status,
           case when failed = 0 then 'All records passed validation'
                when failed * 100e0 / total <= failure_threshold
                then failed || ' violations found but within threshold (' || cast(failure_threshold as varchar) || '%)'
                else failed || ' violations exceed threshold (' || cast(failure_threshold as varchar) || '%)' end as test_message
    from rule_counts""")
define("dq_exceptions", " union all ".join(
    f"""select 15 * {_run} + rule_id as result_id, rule_id, table_name, record_identifier, column_name,
               substring(coalesce(failed_value, 'None'), 1, 1000) as failed_value,
               substring(coalesce(expected_value, 'None'), 1, 1000) as expected_value,
               md5(concat_ws('_', cast(rule_id as varchar), record_identifier, column_name, coalesce(failed_value, 'None'))) as exception_hash,
               timestamp '{RUNS[_run]}' as detected_date, 'OPEN' as resolution_status
        from (select *, row_number() over (partition by rule_id order by record_identifier, failed_value) as n
              from violations_{_run}) v where n <= 1000""" for _run in range(len(RUNS))))


def _score(name: str) -> str:
    mine = f"filter (where category_name = '{name}')"
    return "coalesce(" + sql_percent(
        f"(sum(total_records_checked - failed_records) {mine})", f"(sum(total_records_checked) {mine})"
    ) + ", 100e0)"


_SCORES = [f"{n.lower()}_score" for n, _ in CATEGORIES]
define("scored", f"""
    select cast(execution_date as date) as report_date, 'DAILY' as report_period, count(*) as total_rules_executed,
           count(*) filter (where test_status = 'PASSED') as rules_passed,
           count(*) filter (where test_status = 'FAILED') as rules_failed,
           count(*) filter (where test_status = 'WARNING') as rules_warning,
           {', '.join(f'{_score(n)} as {s}' for (n, _), s in zip(CATEGORIES, _SCORES))},
           cast(sum(total_records_checked) as bigint) as total_records_checked,
           cast(sum(failed_records) as bigint) as total_failed_records
    from dq_test_results t join dq_rules r on t.rule_id = r.rule_id join dq_rule_categories k on r.category_id = k.category_id
    group by 1""")
define("dq_scorecards", f"""
    select *, {sql_round('((' + ' + '.join(_SCORES) + ') / 7e0)')} as overall_quality_score from scored""")

_RESULT = ("rule_id, total_records_checked, failed_records, passed_records, failure_percentage, test_status, test_message")


@query("E01_rule_factories", "select * from violations_1")
def _(c: Context) -> DataFrame:
    return engine.violation_records(c.tables, list(enumerate(RULES, start=1)), RUNS[1].date())


@query("E02_rule_registry", """
    select r.rule_id, r.rule_name, r.category_id, r.target_table, r.target_column, r.rule_type, r.severity,
           case when r.rule_id = 1 then 7.5e0 else r.failure_threshold end as failure_threshold, r.is_active, z.total as target_rows
    from dq_rules r join table_sizes z on r.target_table = z.target_table""")
def _(c: Context) -> DataFrame:
    # the first ten rules are known; registering all fifteen updates one and adds five
    from dataclasses import replace

    cats = engine.categories(c.spark)
    known = engine.register_rules(c.spark, cats, None, RULES[:10])
    updated = engine.register_rules(c.spark, cats, known, (replace(RULES[0], threshold=7.5), *RULES[1:]))
    sizes = [
        c[t].agg(F.lit(t).alias("target_table"), F.count(F.lit(1)).alias("target_rows"))
        for t in ("dim_customer", "dim_product", "fact_transactions")
    ]
    joined = updated.join(sizes[0].union(sizes[1]).union(sizes[2]), "target_table")
    return joined.select(
        "rule_id", "rule_name", "category_id", "target_table", "target_column", "rule_type", "severity",
        "failure_threshold", "is_active", "target_rows",
    )


@query("E03_execute_rule", f"select {_RESULT} from dq_test_results where result_id > 15 and rule_id in (1, 10)")
def _(c: Context) -> DataFrame:
    first, _ = engine.execute_rule(c.spark, c.tables, RULES[0], 1, RUNS[1].date())
    tenth, _ = engine.execute_rule(c.spark, c.tables, RULES[9], 10, RUNS[1].date())
    return first.union(tenth).select(*_RESULT.split(", "))


@query("E04_stored_results", f"select result_id, execution_date, {_RESULT} from dq_test_results")
def _(c: Context) -> DataFrame:
    return dq(c)["dq_test_results"].select("result_id", "execution_date", *_RESULT.split(", "))


_EXCEPTION = "rule_id, table_name, record_identifier, column_name, failed_value, expected_value, exception_hash"


@query("E05_stored_exceptions", f"""
    select row_number() over (order by result_id, record_identifier, failed_value) as exception_id, result_id,
           {_EXCEPTION}, resolution_status from dq_exceptions""")
def _(c: Context) -> DataFrame:
    return dq(c)["dq_exceptions"].select("exception_id", "result_id", *_EXCEPTION.split(", "), "resolution_status")


@query("E06_run_all_rules", """
    select count(*) as total_rules, count(*) filter (where test_status = 'PASSED') as passed,
           count(*) filter (where test_status = 'FAILED') as failed, count(*) filter (where test_status = 'WARNING') as warning,
           count(*) filter (where test_status = 'ERROR') as error
    from dq_test_results where result_id > 15""")
def _(c: Context) -> DataFrame:
    registry = engine.register_rules(c.spark, engine.categories(c.spark))
    return engine.summary(engine.run_rules(c.spark, c.tables, registry, RUNS[1].date()))


_CARD = ("report_date, report_period, total_rules_executed, rules_passed, rules_failed, rules_warning, "
         "overall_quality_score, " + ", ".join(_SCORES) + ", total_records_checked, total_failed_records")


@query("E07_scorecard", f"select {_CARD} from dq_scorecards where report_date = date '{SALES_AS_OF}'")
def _(c: Context) -> DataFrame:
    q = dq(c)
    return engine.scorecard(q["dq_test_results"], q["dq_rules"], q["dq_rule_categories"], SALES_AS_OF)


@query("E08_scorecard_upsert", f"select {_CARD} from dq_scorecards")
def _(c: Context) -> DataFrame:
    # the second day is scored again: its row is replaced, not added
    from tillstar.operators.rows import upsert

    q = dq(c)
    again = engine.scorecard(q["dq_test_results"], q["dq_rules"], q["dq_rule_categories"], SALES_AS_OF)
    return upsert(q["dq_scorecards"], again, ["report_date", "report_period"]).select(*_CARD.split(", "))


@query("E09_active_rules", """
    select r.rule_id, rule_name, category_name, target_table, target_column, severity, is_active,
           count(t.result_id) as execution_count, max(t.execution_date) as last_execution
    from dq_rules r left join dq_rule_categories k on r.category_id = k.category_id
    left join dq_test_results t on r.rule_id = t.rule_id
    where is_active group by all""")
def _(c: Context) -> DataFrame:
    q = dq(c)
    return reports.active_rules(q["dq_rules"], q["dq_rule_categories"], q["dq_test_results"])


@query("E10_latest_scores", f"""
    select report_date, report_period, overall_quality_score, {', '.join(_SCORES)}, total_rules_executed, rules_passed,
           rules_failed, rules_warning from dq_scorecards where report_date = (select max(report_date) from dq_scorecards)""")
def _(c: Context) -> DataFrame:
    return reports.latest_scores(dq(c)["dq_scorecards"])


@query("E11_open_exceptions", f"""
    select row_number() over (order by result_id, record_identifier, failed_value) as exception_id, rule_name,
           category_name, table_name, column_name, resolution_status, detected_date,
           cast(datediff('day', cast(detected_date as date), date '{SALES_AS_OF}') as int) as days_open
    from dq_exceptions e join dq_rules r on e.rule_id = r.rule_id join dq_rule_categories k on r.category_id = k.category_id""")
def _(c: Context) -> DataFrame:
    q = dq(c)
    return reports.open_exceptions(q["dq_exceptions"], q["dq_rules"], q["dq_rule_categories"], SALES_AS_OF)


@query("E12_latest_scorecard", f"select {_CARD} from dq_scorecards order by report_date desc limit 1")
def _(c: Context) -> DataFrame:
    return reports.latest_scorecard(dq(c)["dq_scorecards"]).select(*_CARD.split(", "))


@query("E12_score_trend", f"""
    select report_date, overall_quality_score, {', '.join(_SCORES)}, rules_passed, rules_warning, rules_failed
    from dq_scorecards where report_date >= date '{SALES_AS_OF}' - 30""")
def _(c: Context) -> DataFrame:
    return reports.score_trend(dq(c)["dq_scorecards"], SALES_AS_OF)


@query("E13_recent_results", f"""
    select rule_name, rule_description, category_name, r.target_table, severity, test_status, total_records_checked,
           failed_records, passed_records, failure_percentage, test_message, execution_date
    from dq_test_results t join dq_rules r on t.rule_id = r.rule_id join dq_rule_categories k on r.category_id = k.category_id
    where execution_date >= date '{SALES_AS_OF}' - 1""")
def _(c: Context) -> DataFrame:
    q = dq(c)
    recent = reports.recent_results(q["dq_test_results"], q["dq_rules"], q["dq_rule_categories"], SALES_AS_OF)
    return recent.drop("execution_duration_ms")


@query("E14_top_exceptions", f"""
    select rule_name, category_name, table_name, record_identifier, column_name, failed_value, expected_value, detected_date
    from dq_exceptions e join dq_rules r on e.rule_id = r.rule_id join dq_rule_categories k on r.category_id = k.category_id
    where detected_date >= date '{SALES_AS_OF}' - 7
    order by detected_date desc, result_id, record_identifier, failed_value limit 100""")
def _(c: Context) -> DataFrame:
    q = dq(c)
    return reports.top_exceptions(q["dq_exceptions"], q["dq_rules"], q["dq_rule_categories"], SALES_AS_OF)


@query("E15_score_bands", f"""
    select report_date, report_period, overall_quality_score,
           case when overall_quality_score >= 95 then 'EXCELLENT' when overall_quality_score >= 80 then 'GOOD'
                when overall_quality_score >= 60 then 'FAIR' else 'NEEDS ATTENTION' end as score_band,
           {sql_percent('rules_passed', 'total_rules_executed')} as pass_rate,
           {sql_percent('total_failed_records', 'total_records_checked')} as failure_rate
    from dq_scorecards""")
def _(c: Context) -> DataFrame:
    return reports.headline(dq(c)["dq_scorecards"])


@query("E16_recommendations", f"""
    select report_date, report_period, recommendation,
           cast(row_number() over (partition by report_date order by rank) - 1 as int) as position
    from (select report_date, report_period, 1 as rank, '{reports.ADVICE_FAILED}' as recommendation
          from dq_scorecards where rules_failed > 0
          union all select report_date, report_period, 2, '{reports.ADVICE_INCOMPLETE}'
          from dq_scorecards where completeness_score < 95
          union all select report_date, report_period, 3,
                 case when overall_quality_score >= 95 then '{reports.ADVICE_EXCELLENT}'
                      when overall_quality_score >= 80 then '{reports.ADVICE_GOOD}' else '{reports.ADVICE_POOR}' end
          from dq_scorecards) q""")
def _(c: Context) -> DataFrame:
    return reports.recommendations(dq(c)["dq_scorecards"])


@query("E17_categories", """
    select k.category_id, k.category_name, k.category_description, count(e.rule_id) as open_exceptions
    from dq_rule_categories k join dq_rules r on k.category_id = r.category_id
    left join dq_exceptions e on e.rule_id = r.rule_id group by all""")
def _(c: Context) -> DataFrame:
    q = dq(c)
    found = q["dq_exceptions"].join(q["dq_rules"].select("rule_id", "category_id"), "rule_id").groupBy("category_id").agg(
        F.count(F.lit(1)).alias("open_exceptions")
    )
    return q["dq_rule_categories"].join(found, "category_id", "left").fillna(0, ["open_exceptions"])


