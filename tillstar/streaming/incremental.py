"""High-water-mark extraction, and incremental fact loads by load id with retries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.keys import released_after, stored_once
from tillstar.operators.rows import latest_load, upsert
from tillstar.plans import facts, warehouse
from tillstar.sources.tables import TableStore

MARKS = "load_marks"
_MARK_SCHEMA = "source string, mark timestamp_ntz"
TAKEN = "loads_taken"
_TAKEN_SCHEMA = "source string, load_id bigint"


class Pull(NamedTuple):
    rows: DataFrame
    mark: dt.datetime | None


def stored_mark(store: TableStore, source: str) -> dt.datetime | None:
    if not store.exists(MARKS):
        return None
    row = store.read(MARKS).filter(F.col("source") == source).first()
    return row["mark"] if row else None


def pull(store: TableStore, df: DataFrame, source: str, column: str = "load_timestamp") -> Pull:
    """Rows above the stored mark, and the mark to store once they are loaded.

    The new mark is fixed before the rows are read and bounds them from above, so a row that
    arrives meanwhile is left to the next pull. Both bounds are pushed down to the scan. A row that
    becomes visible later with a stamp below the mark is not pulled: use it for sources whose stamps only
    grow; fact loads go by load id instead.
    """
    old = stored_mark(store, source)
    fresh = df if old is None else df.filter(F.col(column) > F.lit(old))
    new = fresh.agg(F.max(column)).first()[0]
    if new is None:
        return Pull(fresh.limit(0), old)
    return Pull(fresh.filter(F.col(column) <= F.lit(new)), new)


def advance(store: TableStore, source: str, mark: dt.datetime | None) -> None:
    """Store the mark of a source after its rows have been loaded."""
    if mark is None:
        return
    row = store.spark.createDataFrame([(source, mark)], _MARK_SCHEMA)
    marks = upsert(store.read(MARKS), row, ["source"]) if store.exists(MARKS) else row
    store.replace(marks.coalesce(1), MARKS)


def new_loads(store: TableStore, staging: TableStore, source: str) -> list[int]:
    """Ids of loads into a staging table that were not taken yet, however late they committed.

    The load log tells which loads succeeded; without a log all staged loads count.
    """
    if staging.exists("stg_audit_log"):
        done = staging.read("stg_audit_log").filter((F.col("table_name") == source) & (F.col("load_status") == "SUCCESS"))
    else:
        done = staging.read(source)
    ids = {r["load_id"] for r in done.select("load_id").filter("load_id is not null").distinct().collect()}  # one per load
    if store.exists(TAKEN):
        ids -= {r["load_id"] for r in store.read(TAKEN).filter(F.col("source") == source).collect()}
    return sorted(ids)


def load_with_pending(
    store: TableStore, source: str, fact: str, key: str, fresh: DataFrame, load: Callable[[DataFrame], int]
) -> int:
    """Load fresh staged rows together with those that earlier loads could not match.

    What has no fact row afterwards, because its lines, customer, product or campaign are not there
    yet, is kept as pending and tried again with every later load. ``load`` gets each key once. Repeating a batch, or failing
    anywhere in between, adds nothing twice and loses nothing.
    """
    pending = f"pending_{source}"
    batch = fresh.filter(F.col(key).isNotNull())
    if store.exists(pending):
        batch = batch.unionByName(store.read(pending), allowMissingColumns=True)
    with released_after(store.spark):
        batch = stored_once(latest_load(batch, key), pending)
        added = load(batch)
        left = facts.not_loaded(batch, warehouse.loaded_ids(store, fact, key, batch), key) if store.exists(fact) else batch
        store.replace(left, pending)
    return added


def load_increment(
    store: TableStore, staging: TableStore, dimensions_as_of: dt.date | None = None
) -> dict[str, int]:
    """Load staged transactions and responses of loads not taken yet, and retry pending ones.

    With ``dimensions_as_of`` the dimensions are refreshed from staging first. Lines that arrive for an order already
    loaded stay out.
    """
    if dimensions_as_of is not None:
        dims = ("stg_products", "stg_marketing_campaigns", "stg_crm_customers")
        warehouse.load_dimensions(store, {n: staging.read(n) for n in dims}, dimensions_as_of)
    items = staging.read("stg_ecom_transaction_items")
    steps = {
        "transactions": ("stg_ecom_transactions", "fact_transactions", "transaction_id",
                         lambda batch: warehouse.load_transactions(store, batch, items, reduced=True)),
        "campaign_responses": ("stg_campaign_responses", "fact_campaign_responses", "response_id",
                               lambda batch: warehouse.load_responses(store, batch)),
    }
    counts = {}
    for name, (source, fact, key, load) in steps.items():
        ids = new_loads(store, staging, source)
        fresh = staging.read(source).filter(F.col("load_id").isin(ids))
        counts[name] = load_with_pending(store, source, fact, key, fresh, load)
        if ids:
            taken = store.spark.createDataFrame([(source, i) for i in ids], _TAKEN_SCHEMA)
            store.append(taken.coalesce(1), TAKEN)
    return counts
