"""Loading the warehouse tables of a store."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.operators.keys import released_after, stored_once
from tillstar.plans import dimensions, facts, maintenance
from tillstar.sources.ledger import IdLedger
from tillstar.sources.tables import TableStore

# The date dimension holds one row per day of this range at least, and of all years with staged facts.
FIRST_DAY = dt.date(1995, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)


class Tables(Mapping[str, DataFrame]):
    """The stored warehouse tables by name, each read when asked for."""

    def __init__(self, store: TableStore):
        self.store = store

    def __getitem__(self, name: str) -> DataFrame:
        return self.store.read(name)

    def __iter__(self) -> Iterator[str]:
        return iter([n for n in schemas.WAREHOUSE if self.store.exists(n)])

    def __len__(self) -> int:
        return sum(1 for _ in self)


def load_dates(store: TableStore, start: dt.date = FIRST_DAY, end: dt.date = LAST_DAY) -> int:
    """Days not in the date dimension yet are added; running it again adds nothing."""
    from tillstar.operators.rows import insert_missing

    days = dimensions.build_date(store.spark, start, end)
    if store.exists("dim_date"):
        days = insert_missing(store.read("dim_date"), days, ["date_key"])
    return store.replace(days.coalesce(1), "dim_date")


def cover_dates(store: TableStore, staged: DataFrame, column: str) -> None:
    """Extend the date dimension to whole years around all days of ``column``, so no fact is without its day."""
    bounds = staged.agg(F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last")).first()
    if bounds["first"] is None or not store.exists("dim_date"):
        return
    known = store.read("dim_date").agg(F.min("date_actual").alias("first"), F.max("date_actual").alias("last")).first()
    if known["first"] is None or bounds["first"] < known["first"] or bounds["last"] > known["last"]:
        days = [d for d in (*bounds, *known) if d is not None]
        load_dates(store, dt.date(min(days).year, 1, 1), dt.date(max(days).year, 12, 31))


def load_products(store: TableStore, staged: DataFrame) -> int:
    if store.exists("dim_product"):
        return store.replace(dimensions.upsert_product(store.read("dim_product"), staged), "dim_product")
    return store.replace(dimensions.build_product(staged), "dim_product")


def load_campaigns(store: TableStore, staged: DataFrame, update: bool = False) -> int:
    if store.exists("dim_campaign"):
        loaded = dimensions.load_campaign(store.read("dim_campaign"), staged, update)
        return store.replace(loaded, "dim_campaign")
    return store.replace(dimensions.build_campaign(staged), "dim_campaign")


def load_customers(store: TableStore, staged: DataFrame, as_of: dt.date) -> dict[str, int]:
    """Merge a customer snapshot; returns keys per change label."""
    with released_after(store.spark):
        counts = maintenance.merge_customers(store, staged, as_of)
    return {
        "customers_new": counts.get("new", 0),
        "customers_updated": counts.get("scd2_changed", 0),
        "customers_unchanged": counts.get("unchanged", 0) + counts.get("type1_changed", 0),
    }


def load_dimensions(store: TableStore, staged: Mapping[str, DataFrame], as_of: dt.date) -> dict[str, int]:
    """Products, then campaigns, then customers."""
    load_dates(store)
    counts = {
        "products": load_products(store, staged["stg_products"]),
        "campaigns": load_campaigns(store, staged["stg_marketing_campaigns"]),
    }
    return counts | load_customers(store, staged["stg_crm_customers"], as_of)


def loaded_ids(store: TableStore, fact: str, key: str, batch: DataFrame) -> DataFrame:
    """Ids of a fact among which all that a batch shares with it are, read from a list that is kept beside the fact."""
    return IdLedger(store, fact, key).candidates(batch)


def _next_key(store: TableStore, fact: str, key: str) -> Column | int:
    """The key after the highest one, from the manifest where all parts note theirs."""
    noted = store.highest(fact, key)
    return noted + 1 if noted is not None else F.coalesce(store.read(fact).agg(F.max(key)).scalar(), F.lit(0)) + 1


def load_transactions(store: TableStore, transactions: DataFrame, items: DataFrame, reduced: bool = False) -> int:
    """Append transactions the fact does not hold; returns the rows added. ``reduced`` transactions hold each id once."""
    cover_dates(store, transactions, "transaction_date")
    with released_after(store.spark):
        return _load_transactions(store, transactions, items, reduced)


def _load_transactions(store: TableStore, transactions: DataFrame, items: DataFrame, reduced: bool) -> int:
    fact, key = "fact_transactions", "transaction_key"
    customer, product = store.read("dim_customer"), store.read("dim_product")
    if store.exists(fact):
        # stored: the headers are needed twice, and without any the lines need not be read
        known = loaded_ids(store, fact, "transaction_id", transactions)
        fresh = stored_once(facts.not_loaded(transactions, known, "transaction_id"), "fresh")
        if fresh.isEmpty():
            return 0
        rows = facts.lines_of(fresh, _next_key(store, fact, key), items, customer, product, reduced)
    else:
        rows = facts.build_transactions(transactions, items, customer, product, reduced=reduced)
    return store.append(rows, fact, [facts.YEAR], highest=[key])


def load_responses(store: TableStore, responses: DataFrame) -> int:
    """Append responses the fact does not hold; returns the rows added."""
    cover_dates(store, responses, "response_date")
    fact, key = "fact_campaign_responses", "response_key"
    with released_after(store.spark):
        more = {}
        if store.exists(fact):
            more = {"loaded": loaded_ids(store, fact, "response_id", responses), "start": _next_key(store, fact, key)}
        rows = facts.build_responses(responses, store.read("dim_customer"), store.read("dim_campaign"), **more)
        return store.append(rows, fact, highest=[key])


def load_facts(store: TableStore, staged: Mapping[str, DataFrame]) -> dict[str, int]:
    return {
        "transactions": load_transactions(
            store, staged["stg_ecom_transactions"], staged["stg_ecom_transaction_items"]
        ),
        "campaign_responses": load_responses(store, staged["stg_campaign_responses"]),
    }


def refresh_metrics(store: TableStore) -> int:
    """Lifetime metrics of customers with new sales; returns the customer versions."""
    with released_after(store.spark):
        return maintenance.refresh_metrics(store)


def build_aggregates(store: TableStore) -> dict[str, int]:
    """Both aggregates, months with new sales only once they exist; returns their rows."""
    return maintenance.build_aggregates(store)


def full_load(
    store: TableStore, staged: Mapping[str, DataFrame], as_of: dt.date
) -> tuple[Tables, dict[str, int], dict[str, float]]:
    """Dimensions, facts, customer metrics, aggregates. Returns the tables, row counts and
    seconds per phase. Running it again on the same staging data changes nothing."""
    counts: dict[str, int] = {}
    seconds: dict[str, float] = {}
    phases = {
        "dimensions": lambda: load_dimensions(store, staged, as_of),
        "facts": lambda: load_facts(store, staged),
        "metrics": lambda: {"customer_versions": refresh_metrics(store)},
        "aggregates": lambda: build_aggregates(store),
    }
    for name, phase in phases.items():
        began = time.monotonic()
        counts |= phase()
        seconds[name] = time.monotonic() - began
    return Tables(store), counts, seconds
