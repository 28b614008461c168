"""Row counts, referential integrity, constraint and join-coverage reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.operators.keys import ranges_for
from tillstar.operators.lookup import lookup_scd2
from tillstar.operators.rows import not_yet_in

# The counted tables.
COUNTED = (
    "dim_customer", "dim_product", "dim_campaign", "dim_date", "fact_transactions", "fact_campaign_responses",
)

# The reported references (fact, column, dimension, key).
REFERENCES = (
    ("fact_transactions", "customer_key", "dim_customer", "customer_key"),
    ("fact_transactions", "product_key", "dim_product", "product_key"),
    ("fact_transactions", "transaction_date_key", "dim_date", "date_key"),
    ("fact_campaign_responses", "customer_key", "dim_customer", "customer_key"),
    ("fact_campaign_responses", "campaign_key", "dim_campaign", "campaign_key"),
)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def row_counts(tables: Mapping[str, DataFrame], names=COUNTED) -> DataFrame:
    return _union(
        [tables[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n in names]
    )


def orphans(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Number of fact rows whose reference is missing from the dimension. Fact rows are
    counted per reference first, so only distinct references are joined."""
    used = fact.groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias("_rows"))
    return not_yet_in(used, dim, [key]).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_count"))


def integrity_report(tables: Mapping[str, DataFrame], references=REFERENCES, count_missing: bool = True) -> DataFrame:
    """Rows and orphans of each reference (fact, column, dimension, key); every fact and dimension is read once.

    A row is combined with others of the same reference and value before the shuffle, so only distinct
    values are joined. A missing value is an orphan, unless ``count_missing`` is off.
    """
    by_fact: dict[str, list[int]] = {}
    by_dim: dict[tuple[str, str], list[int]] = {}
    for i, (fact, _, dim, key) in enumerate(references):
        by_fact.setdefault(fact, []).append(i)
        by_dim.setdefault((dim, key), []).append(i)

    def entries(df: DataFrame, columns: list[tuple[int, str]]) -> DataFrame:
        cells = [F.struct(F.lit(i).alias("_ref"), F.col(c).cast("bigint").alias("_value")) for i, c in columns]
        return df.select(F.inline(F.array(*cells)))

    used = _union([entries(tables[fact], [(i, references[i][1]) for i in own]) for fact, own in by_fact.items()])
    if not count_missing:
        used = used.filter("_value is not null")
    used = used.groupBy("_ref", "_value").agg(F.count(F.lit(1)).alias("_rows"))
    known = _union([entries(tables[dim], [(i, key) for i in own]) for (dim, key), own in by_dim.items()])
    found = used.join(known.withColumn("_known", F.lit(True)).distinct(), ["_ref", "_value"], "left")

    def total(i: int, rows: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_ref") == i, rows)), F.lit(0)).cast("bigint")

    rows, lost = F.col("_rows"), F.when(F.col("_known").isNull(), F.col("_rows"))
    counted = found.agg(*[total(i, x).alias(f"{n}{i}") for i in range(len(references)) for n, x in (("all", rows), ("lost", lost))])
    cells = [
        F.struct(
            F.lit(fact).alias("fact_table"), F.lit(column).alias("fk_column"), F.lit(dim).alias("dim_table"),
            F.col(f"all{i}").alias("records"), F.col(f"lost{i}").alias("orphan_count"))
        for i, (fact, column, dim, _) in enumerate(references)
    ]
    return counted.select(F.inline(F.array(*cells)))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values with several rows.

    Keys are nearly all distinct, so combining them before the shuffle would only fill the memory of the scanning tasks. Of a
    long table they are dealt by value to tasks of bounded size first.
    """
    keys = df.select(*key)
    dealt = ranges_for(df.sparkSession, df.count())
    return (keys.repartition(dealt, *key) if dealt else keys).groupBy(*key).count().filter("count > 1")


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of the declared keys, mandatory columns and references, one row each."""
    rows = []

    def row(table: str, kind: str, columns: str, counted: DataFrame) -> None:
        rows.append(
            counted.select(
                F.lit(table).alias("table_name"), F.lit(kind).alias("constraint_type"),
                F.lit(columns).alias("columns"), F.col("violations").cast("bigint").alias("violations"),
            )
        )

    for table, rules in schemas.CONSTRAINTS.items():
        df = tables[table]
        for key in rules["unique"]:
            row(table, "unique", ",".join(key), repeated_keys(df, key).agg(F.count(F.lit(1)).alias("violations")))
        # all mandatory columns of a table in one scan
        missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rules["not_null"]])
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in rules["not_null"]])
        rows.append(
            missing.select(F.inline(pairs)).select(
                F.lit(table).alias("table_name"), F.lit("not_null").alias("constraint_type"),
                F.col("c").alias("columns"), F.col("v").alias("violations"),
            )
        )
    references = [(table, *r) for table, rules in schemas.CONSTRAINTS.items() for r in rules["references"]]
    rows.append(
        integrity_report(tables, references, count_missing=False).select(
            F.col("fact_table").alias("table_name"), F.lit("foreign_key").alias("constraint_type"),
            F.col("fk_column").alias("columns"), F.col("orphan_count").alias("violations"))
    )
    return _union(rows)


def overlong_text(df: DataFrame, table: str) -> DataFrame:
    """Rows per column whose text exceeds the declared width, from one scan."""
    widths = schemas.TEXT_WIDTHS[table]
    counted = df.agg(
        *[F.count_if(F.length(c) > w).alias(f"_over_{c}") for c, w in widths.items()],
        *[F.coalesce(F.max(F.length(c)), F.lit(0)).alias(f"_max_{c}") for c in widths],
    )
    cells = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(w).alias("declared_width"),
            F.col(f"_max_{c}").alias("longest"), F.col(f"_over_{c}").alias("violations"),
        )
        for c, w in widths.items()
    ]
    return counted.select(F.inline(F.array(*cells)))


def join_coverage(
    transactions: DataFrame, items: DataFrame, dim_customer: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """How far staged sales reach the dimensions, as (metric, value) rows.

    Covers table sizes, the staged date span, sample ids, and matches with and without the
    validity range, with the first matching transaction as an example.
    """

    one = F.count(F.lit(1))
    day = F.to_date("transaction_date")
    current = transactions.join(dim_customer.filter("is_current").select("customer_id"), "customer_id")
    dated = lookup_scd2(transactions, dim_customer, "customer_id", "transaction_date", "customer_key")

    def values(df: DataFrame, **metrics: Column) -> DataFrame:
        """All metrics of a table from one aggregate over it."""
        counted = df.agg(*[c.cast("string").alias(n) for n, c in metrics.items()])
        return counted.select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in metrics])))

    return _union(
        [
            values(transactions, staged_transactions=one, first_transaction_date=F.min(day), last_transaction_date=F.max(day),
                   first_staged_customer_id=F.min("customer_id")),
            values(items, staged_items=one, first_staged_product_id=F.min("product_id")),
            values(dim_customer, customer_versions=one, first_dimension_customer_id=F.min("customer_id")),
            values(dim_product, products=one, first_dimension_product_id=F.min("product_id")),
            values(current, transactions_matching_current_customer=one),
            values(dated, transactions_matching_valid_version=one, example_transaction=F.min("transaction_id")),
        ]
    )
