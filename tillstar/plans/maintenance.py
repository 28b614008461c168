"""Upkeep of stored warehouse tables from what was added, without reading what was there."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.operators.keys import ranges_for, released_after, stored_once
from tillstar.operators.scd import scd2_delta
from tillstar.plans import dimensions, facts
from tillstar.sources.tables import Snapshot, TableStore

FACT = "fact_transactions"
SALES = "customer_sales"
CUSTOMERS = "dim_customer"
# Customers of one bucket, about.
BUCKET_CUSTOMERS = 1_000_000
LEAST_BUCKETS = 16
# Folds of customer sales before they are added up.
MOST_FOLDS = 32
# Products up to which their unit costs are small enough to be sent to all tasks.
FEW_PRODUCTS = 2_000_000
_CURRENT, _HISTORY = "c", "h"


# --- customers by bucket --------------------------------------------------------------------


def _bucket(buckets: int, key: str = "customer_id") -> Column:
    return F.format_string("%06d", F.pmod(F.xxhash64(key), F.lit(buckets).cast("bigint")))


def _customer_slot(buckets: int) -> Column:
    kind = F.when(F.coalesce("is_current", F.lit(False)), F.lit(_CURRENT)).otherwise(F.lit(_HISTORY))
    return F.concat(kind, _bucket(buckets))


def _is_current_slot(slot: str) -> bool:
    return slot.startswith(_CURRENT)


def replace_customers(store: TableStore, rows: DataFrame, properties: Mapping | None = None) -> int:
    """Write the customer dimension anew, in slots by whether a version is current and by the hash of the customer."""
    rows = stored_once(rows, "customers")
    buckets = max(LEAST_BUCKETS, -(-rows.count() // BUCKET_CUSTOMERS))
    return store.replace(rows, CUSTOMERS, slot=_customer_slot(buckets), highest=["customer_key"],
                         properties={"buckets": buckets, **(properties or {})})


def _buckets(store: TableStore) -> int:
    """Buckets of the customer dimension, which is put into buckets first if it was written without."""
    if not store.snapshot(CUSTOMERS).slotted:
        replace_customers(store, store.read(CUSTOMERS), store.properties(CUSTOMERS))
    return store.properties(CUSTOMERS)["buckets"]


def merge_customers(store: TableStore, staged: DataFrame, as_of: dt.date) -> dict[str, int]:
    """Merge a customer snapshot; returns keys per change label.

    Only current versions are read. Buckets of current versions that hold a changed or new customer are written again; closed
    versions are added to their bucket of history, whose files stay as they are, like those of
    every bucket without a change.
    """
    if not store.exists(CUSTOMERS):
        merged, changes = dimensions.merge_customer(dimensions.empty(store.spark, CUSTOMERS), staged, as_of)
        counts = {r["change"]: r["customers"] for r in changes.collect()}  # at most four rows
        replace_customers(store, merged)
        return counts
    buckets = _buckets(store)
    before = store.snapshot(CUSTOMERS)
    current = store.read(CUSTOMERS, slots=_is_current_slot, number=before.number)
    delta = scd2_delta(
        current, dimensions.derive_customer(staged, as_of), as_of, business_key="customer_id", surrogate="customer_key",
        highest=_highest_customer(store), tracked=dimensions.TRACKED, in_place=dimensions.IN_PLACE,
        first_valid_from="registration_date")
    touched = [r["b"] for r in delta.changed.select(_bucket(buckets).alias("b")).distinct().collect()]  # one per bucket at most
    if touched:
        rows = delta.carried(store.read(CUSTOMERS, slots=[_CURRENT + b for b in touched], number=before.number)).unionByName(delta.added)
        store.rewrite(rows, CUSTOMERS, _customer_slot(buckets), instead_of=[_CURRENT + b for b in touched],
                      highest=["customer_key"], based_on=before)
    return {r["change"]: r["customers"] for r in delta.changes.collect()}


def _highest_customer(store: TableStore) -> int:
    noted = store.highest(CUSTOMERS, "customer_key")
    return noted if noted is not None else store.read(CUSTOMERS).agg(F.max("customer_key")).first()[0] or 0


# --- lifetime metrics -----------------------------------------------------------------------


def _sales(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_key").agg(
        F.count_distinct("transaction_id").alias("orders"), F.sum("net_amount").cast("decimal(28,2)").alias("spent"))


def _totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_key").agg(
        F.sum("orders").alias("orders"), F.sum("spent").cast("decimal(28,2)").alias("spent"))


def fold_sales(store: TableStore) -> None:
    """Bring the sales per customer version up to date with the fact.

    A transaction is loaded once and as a whole, so numbers of orders add up over loads and a load adds one row for each of its
    customers. The rows are added up when there are many loads; the snapshot of the fact that is covered is published with
    them.
    """
    now = store.numbers(FACT)[-1]
    known = store.properties(SALES)
    added = store.added_since(FACT, known["covers"]) if known else None
    if added is None:
        store.replace(_sales(store.read(FACT, number=now)), SALES, properties={"covers": now, "folds": 0})
    elif added and known["folds"] >= MOST_FOLDS:
        both = store.read(SALES).unionByName(_sales(store.read_parts(FACT, added)))
        store.replace(_totals(both), SALES, properties={"covers": now, "folds": 0})
    elif added:
        store.append(_sales(store.read_parts(FACT, added)), SALES, properties={"covers": now, "folds": known["folds"] + 1})
    elif known["covers"] != now:
        store.note(SALES, covers=now)


def refresh_metrics(store: TableStore) -> int:
    """Set orders and spend of the current versions that got sales since the last refresh; returns the customer versions.

    Reads the new parts of the fact, the folded sales and the buckets of these customers.
    """
    buckets = _buckets(store)
    fold_sales(store)
    before = store.snapshot(CUSTOMERS)
    now = store.properties(SALES)["covers"]
    done = before.properties.get("metrics")
    added = store.added_since(FACT, done) if done is not None else None
    totals = _totals(store.read(SALES))
    current = store.read(CUSTOMERS, slots=_is_current_slot, number=before.number)
    if added is None:
        touched = sorted({p.slot.removeprefix(_CURRENT) for p in before.parts if _is_current_slot(p.slot)})
    elif added:
        keys = store.read_parts(FACT, added).select("customer_key").distinct()
        totals = totals.join(keys, "customer_key", "left_semi")
        hit = current.select("customer_key", _bucket(buckets).alias("b")).join(keys, "customer_key", "left_semi")
        touched = [r["b"] for r in hit.select("b").distinct().collect()]  # one per bucket at most
    else:
        touched = []
    if touched:
        slots = [_CURRENT + b for b in touched]
        rows = dimensions.with_sales(store.read(CUSTOMERS, slots=slots, number=before.number), totals)
        store.rewrite(rows, CUSTOMERS, _customer_slot(buckets), instead_of=slots, highest=["customer_key"],
                      properties={"metrics": now}, based_on=before)
    else:
        store.note(CUSTOMERS, metrics=now)
    return store.count(CUSTOMERS)


# --- aggregates -----------------------------------------------------------------------------


def _cost_mark(product: DataFrame) -> str:
    """Tells apart the unit costs that daily costs were computed from, whatever the order of rows."""
    hashed = F.xxhash64("product_key", "unit_cost")
    row = product.agg(F.count(F.lit(1)), F.sum(hashed.cast("decimal(38,0)")), F.bit_xor(hashed)).first()
    return ":".join(map(str, row))


def _rows(store: TableStore, name: str) -> int:
    """Rows of a table as its manifest notes them; parts that note none are left out."""
    return sum(p.rows or 0 for p in store.snapshot(name).parts)


def _refresh(
    store: TableStore, name: str, build, slot: Column, properties: Mapping, before: Snapshot | None, gathered: bool = False
) -> int:
    """Recompute the months that the fact got lines of since; other months stay as they are. ``gathered`` as for ``replace``."""
    now = store.numbers(FACT)[-1]
    done = before.properties.get("covers") if before else None
    added = store.added_since(FACT, done) if done is not None else None
    if added is None:
        rows = build(store.read(FACT, number=now))
        return store.replace(rows, name, slot=slot, properties={"covers": now, **properties}, gathered=gathered)
    if not added:
        store.note(name, covers=now, **properties)
        return store.count(name)
    months = facts.months_of(store.read_parts(FACT, added))
    rows = build(facts.within_months(store.read(FACT, number=now), months))
    store.rewrite(rows, name, slot, instead_of=[str(m) for m in months], properties={"covers": now, **properties}, based_on=before)
    return store.count(name)


def build_aggregates(store: TableStore) -> dict[str, int]:
    """Bring both aggregates up to date with the fact; returns their rows.

    Both are kept by month. Months with new lines are computed again from the lines of these months, which year folders
    and date order let the scan find. When unit costs have changed since, daily costs are first computed anew from the daily rows.
    """
    monthly, daily = "agg_customer_monthly", "agg_product_daily"
    known = {n: store.snapshot(n) if store.exists(n) and store.snapshot(n).slotted else None for n in (monthly, daily)}
    product = store.read("dim_product")
    costs = _cost_mark(product)
    day_slot = F.floor(F.col("date_key") / 100).cast("string")
    if known[daily] and known[daily].properties.get("costs") != costs:
        with released_after(store.spark):
            again = stored_once(facts.with_costs(store.read(daily), product), "costs")
            store.replace(again, daily, slot=day_slot, properties={**known[daily].properties, "costs": costs})
        known[daily] = store.snapshot(daily)
    ranges = ranges_for(store.spark, _rows(store, FACT))

    def by_day(fact: DataFrame) -> DataFrame:
        return facts.product_daily(facts.by_day_and_product(fact, ranges), product)

    return {
        monthly: _refresh(store, monthly, facts.customer_monthly, F.col("year_month").cast("string"), {}, known[monthly]),
        # ranges of days stay together unless costs come by a shuffle, which many products may need
        daily: _refresh(store, daily, by_day, day_slot, {"costs": costs}, known[daily],
                        gathered=_rows(store, "dim_product") <= FEW_PRODUCTS),
    }


def upkeep(store: TableStore, keep: int = 100) -> dict[str, int]:
    """Merge small parts and expire old snapshots of all warehouse tables; returns folders removed by table."""
    removed = {}
    for name in (*schemas.WAREHOUSE, SALES, f"{FACT}_ids", "fact_campaign_responses_ids"):
        if store.exists(name):
            if not store.snapshot(name).slotted:
                store.compact(name)
            removed[name] = store.expire(name, keep)
    return removed
