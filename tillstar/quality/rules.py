"""Rule definitions. Every rule yields its violations as four text columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators.rows import not_yet_in

Tables = Mapping[str, DataFrame]
COLUMNS = ("record_identifier", "column_name", "failed_value", "expected_value")


@dataclass(frozen=True)
class Grouped:
    """What a rule counts from: rows of a table for each value of a whole-number key, with sums.

    ``judge`` gets the groups (``key``, ``rows`` and a column for each of ``sums``, SQL expressions whose totals are
    ``decimal(28,2)``) and returns one row with the number of violations as ``failed``.
    """

    table: str
    key: str
    judge: Callable[[DataFrame, Tables], DataFrame]
    sums: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    """One rule over one table.

    A rule that looks at single rows is given by ``condition``, a SQL predicate that is true
    for violating rows (``{today}`` stands for the date key of the run's day). Any other rule
    brings a function ``find`` from the tables to its violations, and may say how to count them without it: by ``grouped``, or by
    ``peak``, the highest value of an expression over the table and what is wrong with it. Rules with a condition, a peak or groups of
    one table are counted by one scan of it.
    """

    name: str
    description: str
    category: str
    table: str
    column: str
    rule_type: str
    severity: str
    threshold: float
    identifier: str = ""
    condition: str | None = None
    failed: str = "cast(null as string)"
    expected: str = "''"
    find: Callable[[Tables, dt.date], DataFrame] | None = None
    grouped: Grouped | None = None
    peak: str | None = None
    peak_is_bad: Callable[[Column, dt.date], Column] | None = None
    parameters: Mapping[str, str] = field(default_factory=dict)

    def predicate(self, as_of: dt.date) -> Column:
        return F.expr(self.condition.replace("{today}", f"{as_of:%Y%m%d}"))

    def as_struct(self) -> Column:
        """The violation record of a row that meets ``condition``."""
        return F.struct(
            F.col(self.identifier).cast("string").alias("record_identifier"),
            F.lit(self.column).alias("column_name"),
            F.expr(self.failed).cast("string").alias("failed_value"),
            F.expr(self.expected).cast("string").alias("expected_value"),
        )

    def violations(self, tables: Tables, as_of: dt.date) -> DataFrame:
        if self.find is not None:
            return self.find(tables, as_of)
        return tables[self.table].filter(self.predicate(as_of)).select(self.as_struct().alias("v")).select("v.*")


def _records(df: DataFrame, identifier: Column | str, column: str, failed: Column | str, expected: Column) -> DataFrame:
    ident = F.col(identifier) if isinstance(identifier, str) else identifier
    value = F.col(failed) if isinstance(failed, str) else failed
    return df.select(
        ident.cast("string").alias("record_identifier"), F.lit(column).alias("column_name"),
        value.cast("string").alias("failed_value"), expected.cast("string").alias("expected_value"),
    )


def _scoped(condition: str, scope: str | None) -> str:
    return f"({condition})" if scope is None else f"({condition}) and ({scope})"


def not_null(table: str, key: str, column: str, scope: str | None = None, **about) -> Rule:
    return Rule(table=table, column=column, rule_type="not_null", identifier=key,
                condition=_scoped(f"{column} is null", scope), expected="'NOT NULL'", **about)


def value_range(table: str, key: str, column: str, outside: str, expected: str, **about) -> Rule:
    """``outside`` is the predicate of values out of range."""
    return Rule(table=table, column=column, rule_type="range", identifier=key, condition=outside,
                failed=column, expected=f"'{expected}'", **about)


def pattern(table: str, key: str, column: str, regex: str, expected: str, scope: str | None = None, **about) -> Rule:
    bad = f"{column} is not null and not {column} rlike r'{regex}'"
    return Rule(table=table, column=column, rule_type="regex", identifier=key, condition=_scoped(bad, scope),
                failed=column, expected=f"'{expected}'", parameters={"pattern": regex}, **about)


def unique(table: str, key: str, column: str, scope: str | None = None, **about) -> Rule:
    """One violation per repeated value, carrying the smallest key."""

    def find(tables: Tables, as_of: dt.date) -> DataFrame:
        rows = tables[table] if scope is None else tables[table].filter(scope)
        repeated = rows.groupBy(column).agg(
            F.min(key).alias("_key"), F.count(F.lit(1)).alias("_copies")
        ).filter("_copies > 1")
        return _records(repeated, "_key", column, column, F.lit("UNIQUE"))

    return Rule(table=table, column=column, rule_type="unique", find=find, **about)


def row_check(table: str, key: str, column: str, bad: str, failed: str, expected: str, **about) -> Rule:
    return Rule(table=table, column=column, rule_type="custom_sql", identifier=key, condition=bad, failed=failed,
                expected=expected, **about)


def custom(table: str, column: str, find: Callable[[Tables, dt.date], DataFrame], **about) -> Rule:
    return Rule(table=table, column=column, rule_type="custom_sql", find=find, **about)


def _missing_reference(column: str, dim: str) -> Callable[[Tables, dt.date], DataFrame]:
    def find(tables: Tables, as_of: dt.date) -> DataFrame:
        lost = not_yet_in(tables["fact_transactions"].select("transaction_key", column), tables[dim], [column])
        return _records(lost, "transaction_key", column, column, F.lit("VALID FK"))

    return find


def _references(column: str, dim: str) -> Grouped:
    # counts per reference first: the join then meets each reference once, however hot
    def judge(groups: DataFrame, tables: Tables) -> DataFrame:
        known = tables[dim].select(F.col(column).cast("bigint").alias("key"))
        return not_yet_in(groups, known, ["key"]).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failed"))

    return Grouped("fact_transactions", column, judge)


def _mismatches(sold: DataFrame, tables: Tables) -> DataFrame:
    """Current customers whose lifetime value is not what was ``sold`` (customer_key, _sold) to them."""
    expected = F.coalesce(F.col("_sold"), F.lit(0).cast("decimal(28,2)"))
    customers = tables["dim_customer"].filter("is_current").select("customer_key", "lifetime_value")
    return customers.join(sold, "customer_key", "left").withColumn("_expected", expected).filter(
        F.abs(F.col("lifetime_value") - F.col("_expected")) > F.lit(0.01).cast("decimal(3,2)"))


def _lifetime_mismatch(tables: Tables, as_of: dt.date) -> DataFrame:
    # sales are summed per customer before the join, which then meets each customer once
    sold = tables["fact_transactions"].groupBy("customer_key").agg(
        F.sum("net_amount").cast("decimal(28,2)").alias("_sold")
    )
    off = _mismatches(sold, tables)
    return _records(off, "customer_key", "lifetime_value", "lifetime_value", F.col("_expected"))


def _lifetime_groups() -> Grouped:
    def judge(groups: DataFrame, tables: Tables) -> DataFrame:
        sold = groups.select(F.col("key").alias("customer_key"), F.col("sold").alias("_sold"))
        return _mismatches(sold, tables).agg(F.count(F.lit(1)).alias("failed"))

    return Grouped("fact_transactions", "customer_key", judge, {"sold": "net_amount"})


def _day_of(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def _too_old(last: Column, as_of: dt.date) -> Column:
    return _day_of(last) < F.lit(as_of - dt.timedelta(days=7))


def _stale(tables: Tables, as_of: dt.date) -> DataFrame:
    last = tables["fact_transactions"].agg(F.max("transaction_date_key").alias("_key"))
    late = last.filter(_too_old(F.col("_key"), as_of)).withColumn("_last", _day_of(F.col("_key")))
    return _records(late, F.lit(0), "transaction_date", "_last", F.lit(as_of - dt.timedelta(days=7)))


# Names, descriptions, categories, severities, thresholds and patterns.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

RULES: tuple[Rule, ...] = (
    not_null("dim_customer", "customer_key", "email", "is_current and account_status = 'Active'",
             name="Customer Email Not Null", description="Customer email must not be null for active customers",
             category="Completeness", severity="WARNING", threshold=5.0),
    not_null("dim_customer", "customer_key", "phone_number", "is_current",
             name="Customer Phone Not Null", description="Customer phone should be captured",
             category="Completeness", severity="INFO", threshold=10.0),
    not_null("dim_product", "product_key", "product_category",
             name="Product Category Not Null", description="All products must have a category",
             category="Completeness", severity="CRITICAL", threshold=0.0),
    # the flag belongs to the upper bound only: expired versions under 18 are reported too
    value_range("dim_customer", "customer_key", "age", "(age < 18) or (age > 120 and is_current)", "18-120",
                name="Customer Age Valid Range", description="Customer age must be between 18 and 120",
                category="Accuracy", severity="WARNING", threshold=1.0),
    value_range("fact_transactions", "transaction_key", "net_amount", "net_amount <= 0", "> 0",
                name="Transaction Amount Positive", description="Transaction net amount must be positive",
                category="Accuracy", severity="CRITICAL", threshold=0.1),
    row_check("dim_product", "product_key", "retail_price", "retail_price <= unit_cost", "retail_price", "'> unit_cost'",
              name="Product Price Valid", description="Product retail price must be greater than cost",
              category="Accuracy", severity="WARNING", threshold=2.0),
    unique("dim_customer", "customer_key", "customer_id", "is_current",
           name="Customer ID Unique", description="Customer ID must be unique per is_current flag",
           category="Uniqueness", severity="CRITICAL", threshold=0.0),
    unique("dim_product", "product_key", "product_id",
           name="Product ID Unique", description="Product ID must be unique",
           category="Uniqueness", severity="CRITICAL", threshold=0.0),
    custom("dim_customer", "lifetime_value", _lifetime_mismatch, grouped=_lifetime_groups(),
           name="Customer Lifetime Value Consistency",
           description="Customer lifetime_value should equal sum of transactions",
           category="Consistency", severity="WARNING", threshold=1.0),
    # compares with the gross amount although the description mentions the discount
    row_check("fact_transactions", "transaction_key", "line_total",
              "abs(line_total - quantity * unit_price) > cast(0.01 as decimal(3,2))", "line_total",
              "cast(quantity * unit_price as decimal(18,2))",
              name="Transaction Line Total Accuracy",
              description="Line total should equal quantity * unit_price - discount",
              category="Consistency", severity="CRITICAL", threshold=0.1),
    custom("fact_transactions", "customer_key", _missing_reference("customer_key", "dim_customer"),
           grouped=_references("customer_key", "dim_customer"),
           name="Transaction Customer FK Valid", description="All transactions must have valid customer reference",
           category="Integrity", severity="CRITICAL", threshold=0.0),
    custom("fact_transactions", "product_key", _missing_reference("product_key", "dim_product"),
           grouped=_references("product_key", "dim_product"),
           name="Transaction Product FK Valid", description="All transactions must have valid product reference",
           category="Integrity", severity="CRITICAL", threshold=0.0),
    pattern("dim_customer", "customer_key", "email", EMAIL_PATTERN, "valid email format", "is_current",
            name="Email Format Valid", description="Email addresses must follow standard format",
            category="Validity", severity="WARNING", threshold=2.0),
    row_check("fact_transactions", "transaction_key", "transaction_date_key", "transaction_date_key > {today}",
              "transaction_date_key", "'<= TODAY'",
                 name="Transaction Date Valid", description="Transaction dates must not be in the future",
              category="Validity", severity="CRITICAL", threshold=0.0),
    custom("fact_transactions", "created_date", _stale, peak="transaction_date_key", peak_is_bad=_too_old,
           name="Recent Data Available", description="Transactions should exist within last 7 days",
           category="Timeliness", severity="WARNING", threshold=0.0),
)

CATEGORIES: tuple[tuple[str, str], ...] = (
    ("Completeness", "Checks for missing or null values in critical fields"),
    ("Accuracy", "Validates data matches expected formats and ranges"),
    ("Consistency", "Ensures data is consistent across systems and tables"),
    ("Validity", "Confirms data conforms to business rules and constraints"),
    ("Uniqueness", "Detects duplicate records"),
    ("Timeliness", "Monitors data freshness and SLA compliance"),
    ("Integrity", "Validates referential integrity between tables"),
)
