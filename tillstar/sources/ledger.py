"""Which ids a fact holds, in buckets of a list beside it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.sources.tables import SMALL_PARTS, TableStore

# Ids of one bucket, about; the number of buckets doubles with the list.
BUCKET_IDS = 1_000_000
LEAST_BUCKETS = 16
# Ids that may wait outside the buckets before they are folded into them.
WAITING_IDS = 1_000_000
_WAITING = "new"


class IdLedger:
    """Distinct ``key`` values of a fact, kept current from the fact's own commits.

    Ids of new parts of the fact wait in slot ``new``; when they have become many they are folded into buckets by hash,
    of which only those that get ids are written. A lookup reads what waits (a bounded number)
    and the buckets that the asked ids fall into, so its cost follows the batch and not the fact. The list
    notes the snapshot of the fact it covers together with the ids, so after a crash between the two commits the
    next look makes up for it.
    """

    def __init__(
        self, store: TableStore, fact: str, key: str, *, bucket_ids: int = BUCKET_IDS, waiting_ids: int = WAITING_IDS,
        least_buckets: int = LEAST_BUCKETS,
    ):
        self.store, self.fact, self.key, self.name = store, fact, key, f"{fact}_ids"
        self.bucket_ids, self.waiting_ids, self.least_buckets = bucket_ids, waiting_ids, least_buckets

    def _bucket(self, buckets: int) -> Column:
        return F.format_string("b%06d", F.pmod(F.xxhash64(self.key), F.lit(buckets).cast("bigint")))

    def _rebuild(self, rows: DataFrame, covers: int) -> None:
        ids = rows.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        buckets = self.least_buckets
        while buckets * self.bucket_ids < (count := ids.count()):
            buckets = 2 ** math.ceil(math.log2(count / self.bucket_ids))
        self.store.replace(
            ids, self.name, slot=self._bucket(buckets),
            properties={"covers": covers, "buckets": buckets, "ids": count, "waiting": 0, "waits": 0})

    def catch_up(self) -> dict:
        """Take in the ids of parts the fact got since; returns the list's properties."""
        now = self.store.numbers(self.fact)[-1]
        known = self.store.properties(self.name)
        added = self.store.added_since(self.fact, known["covers"]) if known else None
        if added is None:
            self._rebuild(self.store.read(self.fact, number=now), now)
            return self.store.properties(self.name)
        if known["covers"] == now:
            return known
        if added:
            ids = self.store.read_parts(self.fact, added).select(self.key).filter(F.col(self.key).isNotNull()).distinct()
            more = sum(p.rows or 0 for p in added)  # lines, so an upper bound of the ids
            self.store.append(ids, self.name, slot=F.lit(_WAITING), properties={
                "covers": now, "ids": known["ids"] + more, "waiting": known["waiting"] + more, "waits": known["waits"] + 1})
        else:
            self.store.note(self.name, covers=now)
        known = self.store.properties(self.name)
        if known["waiting"] > self.waiting_ids or known["waits"] > SMALL_PARTS:
            self._fold(known)
            known = self.store.properties(self.name)
        return known

    def _fold(self, known: dict) -> None:
        """Move the waiting ids into their buckets; only these buckets are written."""
        if known["ids"] > 2 * known["buckets"] * self.bucket_ids:
            self._rebuild(self.store.read(self.name), known["covers"])
            return
        based_on = self.store.snapshot(self.name)
        waiting = self.store.read(self.name, slots=[_WAITING])
        touched = self._touched(waiting, known["buckets"])
        rows = self.store.read(self.name, slots=[_WAITING, *touched]).distinct()
        self.store.rewrite(rows, self.name, self._bucket(known["buckets"]), instead_of=[_WAITING, *touched],
                           properties={"waiting": 0, "waits": 0}, based_on=based_on)

    def _touched(self, ids: DataFrame, buckets: int) -> list[str]:
        """Buckets that ids fall into: no more than there are buckets."""
        named = ids.filter(F.col(self.key).isNotNull()).select(self._bucket(buckets).alias("bucket")).distinct()
        return [r["bucket"] for r in named.collect()]

    def candidates(self, batch: DataFrame) -> DataFrame:
        """Ids of the fact among which all that the batch shares with it are."""
        known = self.catch_up()
        return self.store.read(self.name, slots=[_WAITING, *self._touched(batch, known["buckets"])])
