"""Fact and aggregate builds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import date_key, decimal_sum, mean, month_key, percent
from tillstar.operators.keys import with_keys
from tillstar.operators.lookup import lookup, lookup_scd2, own_exchange
from tillstar.operators.rows import already_in, dedupe_staged, latest_load, latest_of_copies, not_yet_in

# Storage partition of the fact. Files are sorted by date within it, so file statistics skip
# within a year and the number of folders stays small.
YEAR = "transaction_year"


def _present(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def headers_with_items(transactions: DataFrame, items: DataFrame) -> DataFrame:
    """Order lines with their header. Both sides are reduced to the latest load first, so
    loading a file twice does not multiply lines."""
    t = latest_load(_present(transactions, "customer_id"), "transaction_id")
    i = dedupe_staged(_present(items, "transaction_id", "product_id"), "transaction_item_id")
    header = t.select(
        "transaction_id", "customer_id", "transaction_date", "order_number", "payment_method", "payment_status",
        "tax_amount", "shipping_amount", "currency_code",
    )
    return header.withColumn("transaction_id", own_exchange("transaction_id")).join(
        i.select("transaction_id", "transaction_item_id", "product_id", "quantity", "unit_price", "line_total",
                 "discount_amount"),
        "transaction_id",
    )


def transaction_lines(
    transactions: DataFrame,
    items: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    inclusive: bool = False,
    keep_orphans: bool = False,
    position: str | None = None,
    only_of: DataFrame | None = None,
    reduced: bool = False,
) -> DataFrame:
    """Fact rows without surrogate key: one per order line.

    Headers look up their customer version before they meet the lines, so the lines are
    shuffled once. Sales outside every version of their customer are dropped, or kept with
    NULL keys when ``keep_orphans`` is set. The net amount subtracts the discount from the
    line total. Header tax and shipping repeat on each line and must not be summed. With
    ``only_of``, distinct transaction ids, lines of other transactions leave the scan before
    copies of a line are ranked; a line keeps its transaction when it is staged again. ``reduced``
    headers hold each transaction once already and are not ranked again.
    """
    how = "left" if keep_orphans else "inner"
    header = _present(transactions, "customer_id", "transaction_id")
    header = (header if reduced else latest_load(header, "transaction_id")).select(
        "transaction_id", "customer_id", F.to_date("transaction_date").alias("_day"), "order_number",
        "payment_method", "payment_status", "tax_amount", "shipping_amount", "currency_code",
    )
    header = lookup_scd2(header, dim_customer, "customer_id", "_day", "customer_key", inclusive=inclusive, how=how)
    lines = dedupe_staged(_present(items, "transaction_id", "product_id"), "transaction_item_id", position, only_of)
    extra = [position] if position else []
    lines = lookup(lines, dim_product, "product_id", "product_key", how=how).select(
        "transaction_id", "product_key", "quantity", "unit_price", "line_total", "discount_amount", *extra
    )
    # a transaction may hold very many lines: let the join split it; headers are the fewer rows, so lines need no sort
    header = header.withColumn("transaction_id", own_exchange("transaction_id")).hint("shuffle_hash")
    return header.join(lines, "transaction_id").withColumns({"transaction_date_key": date_key("_day"), **_derived()})


# Tells exact copies of a line apart, so that many copies still spread over tasks.
_POSITION = "_scan_position"

# Key order of fact rows; rows that are equal in all of these are exact copies.
_LINE_ORDER = (
    "transaction_date_key", "transaction_id", "product_key", "quantity", "unit_price", "line_total",
    "discount_amount", "customer_key",
)


def _derived() -> dict[str, Column]:
    """Columns of a fact row that follow from its others."""
    return {
        "net_amount": (F.col("line_total") - F.col("discount_amount")).cast("decimal(12,2)"),
        "source_system": F.lit("E-COMMERCE"),
    }


def key_transactions(lines: DataFrame, start: Column | int = 1) -> DataFrame:
    """Number fact rows by date and transaction and add the storage year. Derived columns are not moved, but computed again."""
    tie = [c for c in lines.columns if c == _POSITION]
    keep = [*(c for c in schemas.WAREHOUSE["fact_transactions"].names[1:] if c not in _derived()), *tie]
    keyed = with_keys(lines.select(*keep), "transaction_key", [*_LINE_ORDER, *tie], start, store_first=True).withColumns(_derived())
    typed = [F.col(f.name).cast(f.dataType) for f in schemas.WAREHOUSE["fact_transactions"]]
    return keyed.select(*typed, F.floor(F.col("transaction_date_key") / 10000).cast("int").alias(YEAR))


def build_transactions(
    transactions: DataFrame, items: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
    inclusive: bool = False, reduced: bool = False,
) -> DataFrame:
    """First load of the transaction fact. Joined lines are stored before they are keyed, so ``items`` may be computed on the way.
    Only headers with copies are ranked."""
    if not reduced:
        transactions = latest_of_copies(_present(transactions, "customer_id", "transaction_id"), "transaction_id")
    return key_transactions(
        transaction_lines(transactions, items, dim_customer, dim_product, inclusive, position=_POSITION, reduced=True)
    )


def new_transactions(
    start: Column | int, loaded: DataFrame, transactions: DataFrame, items: DataFrame, dim_customer: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    """Rows to append, with keys from ``start`` on: transactions not among the ``loaded`` ids yet, as a whole. Lines that
    arrive for a transaction already loaded are left out."""
    return lines_of(not_loaded(transactions, loaded, "transaction_id"), start, items, dim_customer, dim_product)


def lines_of(
    fresh: DataFrame, start: Column | int, items: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
    reduced: bool = False,
) -> DataFrame:
    """Rows of whole transactions, with keys from ``start`` on; ``reduced`` as for ``transaction_lines``."""
    ids = fresh.select("transaction_id")
    lines = transaction_lines(
        fresh, items, dim_customer, dim_product, position=_POSITION, only_of=ids if reduced else ids.distinct(), reduced=reduced)
    return key_transactions(lines, start)


def not_loaded(batch: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key is not among the ``loaded`` ones.

    The long list of loaded keys is first reduced to those of the batch, which the optimizer can
    broadcast when the batch is small, so it is scanned but not shuffled.
    """
    return not_yet_in(batch, already_in(loaded.select(key), batch, [key], repeated=True), [key], repeated=True)


def response_rows(
    responses: DataFrame, dim_customer: DataFrame, dim_campaign: DataFrame, inclusive: bool = False,
    reduce_copies: Callable[[DataFrame, str], DataFrame] = latest_load,
) -> DataFrame:
    """Fact rows of campaign responses without surrogate key. A response has one type, so at
    most one of its flags is set."""
    latest = reduce_copies(_present(responses, "campaign_id", "customer_id"), "response_id")
    found = lookup_scd2(latest, dim_customer, "customer_id", "response_date", "customer_key", inclusive=inclusive)
    found = lookup(found, dim_campaign, "campaign_id", "campaign_key")

    def flag(kind: str) -> Column:
        return F.coalesce(F.col("response_type") == kind, F.lit(False))

    return found.select(
        "customer_key", "campaign_key", date_key("response_date").alias("response_date_key"), "response_id",
        "response_type", "conversion_value", flag("opened").alias("is_opened"), flag("clicked").alias("is_clicked"),
        flag("converted").alias("is_converted"), F.lit("MARKETING").alias("source_system"),
    )


def build_responses(
    responses: DataFrame, dim_customer: DataFrame, dim_campaign: DataFrame, loaded: DataFrame | None = None,
    start: Column | int = 1, inclusive: bool = False,
) -> DataFrame:
    """Keyed response rows, with keys from ``start`` on; only responses not among the ``loaded`` ids, if these are given."""
    reduce_copies = latest_of_copies
    if loaded is not None:
        # read once: what is left of a batch comes from a join
        responses, reduce_copies = not_loaded(responses, loaded, "response_id"), latest_load
    rows = response_rows(responses, dim_customer, dim_campaign, inclusive, reduce_copies)
    keyed = with_keys(rows, "response_key", ["response_id", "customer_key"], start)
    return keyed.select(*[F.col(f.name).cast(f.dataType) for f in schemas.WAREHOUSE["fact_campaign_responses"]])


def customer_monthly(fact: DataFrame) -> DataFrame:
    """Sales per customer version and month; the average is per line. The month follows from the
    date key, so no sale depends on the calendar."""
    month = F.floor(F.col("transaction_date_key") / 100).cast("int")
    return (
        fact.withColumn("month_start_date", F.make_date(F.floor(month / 100).cast("int"), month % 100, F.lit(1)))
        .groupBy("customer_key", "month_start_date")
        .agg(
            F.count_distinct("transaction_id").alias("total_transactions"),
            F.sum("quantity").alias("total_quantity"),
            decimal_sum("net_amount").alias("total_amount"),
            decimal_sum("discount_amount").alias("total_discount"),
            mean("net_amount").alias("avg_transaction_value"),
        )
        .select(
            "customer_key", month_key("month_start_date").alias("year_month"), "total_transactions",
            "total_quantity", "total_amount", "total_discount", "avg_transaction_value", "month_start_date",
            F.last_day("month_start_date").alias("month_end_date"),
        )
    )


def product_daily(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales, cost and profit per product and day. Cost follows from the unit sum, so the
    product is joined after the aggregation."""
    daily = fact.groupBy("product_key", F.col("transaction_date_key").alias("date_key")).agg(
        F.sum("quantity").alias("units_sold"),
        decimal_sum("net_amount").alias("total_revenue"),
        F.count_distinct("customer_key").alias("unique_customers"),
    )
    return with_costs(daily, dim_product)


def by_day_and_product(fact: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fact rows in ranges of days and products, which ``product_daily`` then groups without another exchange."""
    days = ["transaction_date_key", "product_key"]
    return fact.repartitionByRange(ranges, *days) if ranges else fact.repartitionByRange(*days)


def with_costs(daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Cost and profit of daily rows at the unit costs of the products."""
    cost = (F.coalesce("units_sold", F.lit(0)) * F.col("unit_cost")).cast("decimal(28,2)")
    return (
        daily.join(dim_product.select("product_key", "unit_cost"), "product_key")
        .withColumn("total_cost", cost)
        .withColumn("total_profit", (F.col("total_revenue") - F.col("total_cost")).cast("decimal(28,2)"))
        .select(*schemas.WAREHOUSE["agg_product_daily"].names)
    )


def measure_columns() -> dict[str, Column]:
    """The standard measures over fact rows."""
    return {
        "total_revenue": decimal_sum("net_amount"),
        "total_units_sold": F.sum("quantity"),
        "average_order_value": mean("net_amount"),
        "total_discounts": decimal_sum("discount_amount"),
        "discount_percentage": percent(F.sum("discount_amount"), F.sum("line_total"), None),
        "transaction_count": F.count_distinct("transaction_id"),
        "line_item_count": F.count(F.lit(1)),
    }


def measures(fact: DataFrame, group: Sequence[str] = (), names: Sequence[str] = ()) -> DataFrame:
    """Any of the standard measures, per group or over everything."""
    wanted = [c.alias(n) for n, c in measure_columns().items() if not names or n in names]
    return fact.groupBy(*group).agg(*wanted)


def since(fact: DataFrame, day: dt.date) -> DataFrame:
    """Fact rows from ``day`` on, as bounds on the stored year and date key, so whole
    years are pruned and the rest is skipped by file statistics."""
    rows = fact.filter(F.col("transaction_date_key") >= day.year * 10000 + day.month * 100 + day.day)
    return rows.filter(F.col(YEAR) >= day.year) if YEAR in fact.columns else rows


def months_of(fact: DataFrame) -> list[int]:
    """Months (as yyyymm) that fact rows lie in: a few numbers, whatever the rows."""
    month = F.floor(F.col("transaction_date_key") / 100).cast("int").alias("month")
    return sorted(r["month"] for r in fact.select(month).distinct().collect())


def within_months(fact: DataFrame, months: Sequence[int]) -> DataFrame:
    """Fact rows of these months, as bounds on the stored year and date key; neighbouring months make one range."""
    if not months:
        return fact.limit(0)
    ordinals = sorted({m // 100 * 12 + m % 100 - 1 for m in months})
    ranges: list[list[int]] = []
    for o in ordinals:
        if ranges and ranges[-1][1] == o - 1:
            ranges[-1][1] = o
        else:
            ranges.append([o, o])

    def first_day(o: int) -> int:
        return o // 12 * 10000 + (o % 12 + 1) * 100

    inside = [(F.col("transaction_date_key") > first_day(a)) & (F.col("transaction_date_key") < first_day(b) + 100) for a, b in ranges]
    rows = fact.filter(reduce(lambda x, y: x | y, inside))
    return rows.filter(F.col(YEAR).isin(sorted({m // 100 for m in months}))) if YEAR in fact.columns else rows
