"""Parquet tables as snapshots: atomic appends, replacement by slot, compaction and expiry."""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Callable, Collection, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstar.session import COMPRESSION, file_text, publish_text, remove_folder, child_names

BATCH = "load_batch"
SLOT = "part_slot"
# Parts below so many rows are small; more than so many small ones are merged by the append that makes them too many.
SMALL_ROWS = 1_000_000
SMALL_PARTS = 32
# Files that a write in folders keeps open per task; with more folders than these, the rest of the rows is sorted by folder.
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MOST_OPEN_FILES = 24
_MANIFEST = re.compile(r"(\d{10})\.json")
_COMMITS = threading.Lock()


@contextmanager
def _several_files_open(spark: SparkSession) -> Iterator[None]:
    """Lets tasks write to several folders at once, so that whole partitions are not sorted by folder first. A caller's own setting is kept."""
    if spark.conf.get(_OPEN_FILES, "0") != "0":
        yield
        return
    spark.conf.set(_OPEN_FILES, str(MOST_OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_FILES)


class ChangedMeanwhile(RuntimeError):
    """Parts that a commit wanted to take the place of are not there any more."""


@dataclass(frozen=True)
class Part:
    """Rows of one write (of one slot of it): a folder below the table's data folder."""

    folder: str
    rows: int | None = None
    slot: str | None = None
    highest: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    """What a table holds after one commit."""

    number: int
    version: int
    operation: str
    schema: dict
    parts: tuple[Part, ...]
    added: tuple[Part, ...] = ()
    properties: Mapping[str, Any] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    slotted: bool = False

    @staticmethod
    def parse(text: str) -> Snapshot:
        raw = json.loads(text)
        for name in ("parts", "added"):
            raw[name] = tuple(Part(**p) for p in raw[name])
        return Snapshot(**raw | {"partition_by": tuple(raw["partition_by"])})


class TableStore:
    """Tables under one root folder.

    A write puts its rows into a folder of its own and then publishes a manifest, a small file with the next number that
    lists the parts of the table. Rows of a write become visible at once or never: readers follow the highest
    manifest, a failed write leaves a folder that no manifest names, and a job may read a table while it
    rebuilds it. Two appends may run side by side (the second publishes again on top of the first), but surrogate keys that
    continue from the highest one in force need one load of a table at a time.

    A table may be kept in slots, named by an expression over its rows: ``rewrite`` then takes the place of
    some slots and carries all others by reference. Small parts are merged as they pile up; ``expire`` removes
    what only old snapshots name. Manifests carry properties, so what a table covers is published with its rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- snapshots ---------------------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _manifest(self, name: str, number: int) -> str:
        return f"{self.path(name)}/manifests/{number:010d}.json"

    def numbers(self, name: str) -> list[int]:
        """Numbers of the snapshots that are kept, ascending."""
        found = (_MANIFEST.fullmatch(n) for n in child_names(self.spark, f"{self.path(name)}/manifests"))
        return sorted(int(m[1]) for m in found if m)

    def snapshot(self, name: str, number: int | None = None) -> Snapshot:
        """The snapshot in force, or an older one that is kept."""
        numbers = self.numbers(name) if number is None else [number]
        text = file_text(self.spark, self._manifest(name, numbers[-1])) if numbers else None
        if text is None:
            raise FileNotFoundError(f"no table {name} under {self.root}" if number is None else f"no snapshot {number} of {name}")
        return Snapshot.parse(text)

    def exists(self, name: str) -> bool:
        return bool(self.numbers(name))

    def version(self, name: str) -> int | None:
        """How often the table was written anew."""
        return self.snapshot(name).version if self.exists(name) else None

    def batches(self, name: str) -> list[str]:
        """Writes whose rows the table still has as parts of their own."""
        return sorted({p.folder for p in self.snapshot(name).parts})

    def properties(self, name: str) -> dict[str, Any]:
        return dict(self.snapshot(name).properties) if self.exists(name) else {}

    def highest(self, name: str, column: str) -> int | None:
        """The highest value of a column from the manifest alone; None if a part did not note it."""
        parts = self.snapshot(name).parts
        if any(column not in p.highest for p in parts):
            return None
        return max((p.highest[column] for p in parts), default=0)

    def added_since(self, name: str, number: int) -> list[Part] | None:
        """Parts appended after a snapshot; None if rows were also replaced since, or the way there is not kept any more."""
        kept = self.numbers(name)
        later = [n for n in kept if n > number]
        if number not in kept or (later and later != list(range(number + 1, later[-1] + 1))):
            return None
        added: list[Part] = []
        for n in later:
            s = self.snapshot(name, n)
            if s.operation not in ("append", "compact", "note"):
                return None
            added += s.added
        return added

    # --- reading -----------------------------------------------------------------------------

    def _rows(self, name: str, s: Snapshot, parts: Iterable[Part], schema: StructType | None = None) -> DataFrame:
        fields = schema or StructType.fromJson(s.schema)
        paths = list(dict.fromkeys(
            f"{self.path(name)}/data/{BATCH}={p.folder}" + (f"/{SLOT}={p.slot}" if p.slot is not None else "") for p in parts))
        if not paths:
            return self.spark.createDataFrame([], fields)
        reader = self.spark.read.schema(fields).option("basePath", f"{self.path(name)}/data")
        return reader.parquet(*paths).select(*[F.col(f"`{c}`") for c in fields.names])

    def read(
        self, name: str, schema: StructType | None = None, batches: Iterable[str] | None = None,
        slots: Collection[str] | Callable[[str], bool] | None = None, number: int | None = None,
    ) -> DataFrame:
        """The rows in force, or of an older snapshot; of the named batches or slots only if these are given, others are not listed."""
        s = self.snapshot(name, number)
        parts: Iterable[Part] = s.parts
        if batches is not None:
            wanted = set(batches)
            parts = [p for p in parts if p.folder in wanted]
        if slots is not None:
            chosen = slots if callable(slots) else set(slots).__contains__
            parts = [p for p in parts if p.slot is not None and chosen(p.slot)]
        return self._rows(name, s, parts, schema)

    def read_parts(self, name: str, parts: Iterable[Part]) -> DataFrame:
        return self._rows(name, self.snapshot(name), parts)

    def columns(self, name: str) -> list[str]:
        return StructType.fromJson(self.snapshot(name).schema).names

    def has_column(self, name: str, column: str) -> bool:
        return self.exists(name) and column in self.columns(name)

    def count(self, name: str) -> int:
        return self.read(name).count()

    def sql(self, text: str, args: dict | None = None, **tables: str) -> DataFrame:
        """Run a query in which ``{alias}`` stands for a stored table; ``:name`` is a parameter."""
        frames = {alias: self.read(name) for alias, name in tables.items()}
        return self.spark.sql(text, args=args or {}, **frames)

    # --- writing -----------------------------------------------------------------------------

    def _write(
        self, df: DataFrame, name: str, partition_by: Sequence[str], slot: Column | None, highest: Sequence[str],
        gathered: bool = False,
    ) -> tuple[tuple[Part, ...], int]:
        seen = Observation()
        folder = f"b{uuid.uuid4().hex}"  # a letter first: the name must not be taken for a number
        target = f"{self.path(name)}/data/{BATCH}={folder}"
        tops = [F.max(c).cast("bigint").alias(f"top_{c}") for c in highest]
        rows = df
        if slot is not None:
            rows = rows.withColumn(SLOT, F.coalesce(slot, F.lit("none")))
            rows = rows if gathered else rows.hint("rebalance", SLOT)
        # Above the exchange: counts below one without rows are lost when the plan is cut short.
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *tops)
        keys = [SLOT] if slot is not None else list(partition_by)
        with _several_files_open(self.spark):
            (rows.write.partitionBy(*keys) if keys else rows.write).parquet(target, compression=COMPRESSION)
        written = seen.get["rows"]
        if not written:
            return (), 0
        tops_seen = {c: seen.get[f"top_{c}"] for c in highest if seen.get[f"top_{c}"] is not None}
        if slot is None:
            return (Part(folder, written, None, tops_seen),), written
        names = (n.removeprefix(f"{SLOT}=") for n in child_names(self.spark, target) if n.startswith(f"{SLOT}="))
        return tuple(Part(folder, None, n, tops_seen) for n in sorted(names)), written

    def _commit(self, name: str, follow: Callable[[Snapshot | None], Snapshot]) -> Snapshot:
        """Publish what follows from the snapshot in force; again if another commit came first."""
        for _ in range(100):
            base = self.snapshot(name) if self.exists(name) else None
            new = follow(base)
            with _COMMITS:
                if publish_text(self.spark, self._manifest(name, new.number), json.dumps(asdict(new))):
                    return new
        raise ChangedMeanwhile(f"too many other commits to {name}")

    @staticmethod
    def _with_new_columns(schema: dict, more: dict) -> dict:
        known = {f["name"]: f for f in schema["fields"]}
        for f in more["fields"]:
            if f["name"] in known and known[f["name"]]["type"] != f["type"]:
                raise TypeError(f"column {f['name']} is {known[f['name']]['type']} in the table and {f['type']} in the rows")
        return schema | {"fields": [*schema["fields"], *[f for f in more["fields"] if f["name"] not in known]]}

    def append(
        self, df: DataFrame, name: str, partition_by: Sequence[str] = (), *, slot: Column | None = None,
        highest: Sequence[str] = (), properties: Mapping[str, Any] | None = None,
    ) -> int:
        """Add rows; returns the number written, from the same job. Columns the table does not have yet are missing in
        earlier rows. ``highest`` names integer columns whose maximum the manifest notes."""
        if not self.exists(name):
            return self.replace(df, name, partition_by, slot=slot, highest=highest, properties=properties)
        parts, written = self._write(df, name, self.snapshot(name).partition_by, slot, highest)
        schema = _nullable(df.schema)

        def follow(base: Snapshot | None) -> Snapshot:
            return replace(
                base, number=base.number + 1, operation="append", parts=base.parts + parts, added=parts,
                schema=self._with_new_columns(base.schema, schema), properties={**base.properties, **(properties or {})})

        after = self._commit(name, follow)
        if slot is None and sum(p.rows is not None and p.rows < SMALL_ROWS for p in after.parts) > SMALL_PARTS:
            self.compact(name)
        return written

    def replace(
        self, df: DataFrame, name: str, partition_by: Sequence[str] = (), *, slot: Column | None = None,
        highest: Sequence[str] = (), properties: Mapping[str, Any] | None = None, gathered: bool = False,
    ) -> int:
        """Write the whole table anew; returns the number of rows written. Properties are those given. ``gathered`` rows
        lie in few tasks per slot already and are written as they are."""
        parts, written = self._write(df, name, partition_by, slot, highest, gathered)
        schema = _nullable(df.schema)

        def follow(base: Snapshot | None) -> Snapshot:
            return Snapshot(
                number=base.number + 1 if base else 1, version=base.version + 1 if base else 1, operation="replace",
                schema=schema, parts=parts, properties=dict(properties or {}),
                partition_by=tuple(partition_by), slotted=slot is not None)

        self._commit(name, follow)
        return written

    def rewrite(
        self, df: DataFrame, name: str, slot: Column, *, instead_of: Collection[str], highest: Sequence[str] = (),
        properties: Mapping[str, Any] | None = None, based_on: Snapshot | None = None,
    ) -> int:
        """Rows that take the place of whole slots; parts of all other slots stay as they are.

        Rows of slots that are not named are added to them. ``based_on`` is the snapshot that ``df`` was computed from: if the named
        slots have changed since, nothing is published.
        """
        before = based_on or self.snapshot(name)
        if not before.slotted:
            raise ValueError(f"table {name} has no slots")
        gone = {p for p in _keys(before.parts) if p[1] in set(instead_of)}
        parts, written = self._write(df, name, (), slot, highest)

        def follow(base: Snapshot | None) -> Snapshot:
            if {p for p in _keys(base.parts) if p[1] in set(instead_of)} != gone:
                raise ChangedMeanwhile(f"slots of {name} have changed since snapshot {before.number}")
            kept = tuple(p for p in base.parts if (p.folder, p.slot) not in gone)
            return replace(base, number=base.number + 1, operation="rewrite", parts=kept + parts, added=(),
                           properties={**base.properties, **(properties or {})})

        self._commit(name, follow)
        return written

    def note(self, name: str, **properties: Any) -> None:
        """Publish properties without rows."""
        self._commit(name, lambda base: replace(
            base, number=base.number + 1, operation="note", added=(), properties={**base.properties, **properties}))

    # --- upkeep ------------------------------------------------------------------------------

    def compact(self, name: str, small_rows: int = SMALL_ROWS, sort_by: Sequence[str] = ()) -> int:
        """Merge the small parts into one; returns how many there were. Rows, and what later appends added, stay as they are.

        Only small parts are read and written, so the cost is bounded by them and not by the table. Storage
        partitions are kept; within one, rows are ordered by ``sort_by``.
        """
        s = self.snapshot(name)
        if s.slotted:
            raise ValueError("slots are merged by rewriting them")
        small = [p for p in s.parts if p.rows is not None and p.rows < small_rows]
        if len(small) < 2:
            return 0
        noted = set.intersection(*[set(p.highest) for p in small])
        rows = self._rows(name, s, small)
        if s.partition_by or sort_by:
            rows = rows.repartitionByRange(*s.partition_by, *sort_by).sortWithinPartitions(*s.partition_by, *sort_by)
        else:
            rows = rows.coalesce(max(1, sum(p.rows for p in small) // SMALL_ROWS))
        merged, written = self._write(rows, name, s.partition_by, None, sorted(noted))
        gone = _keys(small)
        if written != sum(p.rows for p in small):
            raise ChangedMeanwhile(f"{written} rows merged of {name}")

        def follow(base: Snapshot | None) -> Snapshot:
            if not gone <= _keys(base.parts):
                raise ChangedMeanwhile(f"parts of {name} were replaced while they were merged")
            kept = tuple(p for p in base.parts if (p.folder, p.slot) not in gone)
            return replace(base, number=base.number + 1, operation="compact", parts=kept + merged, added=())

        self._commit(name, follow)
        return len(small)

    def expire(self, name: str, keep: int = 100) -> int:
        """Forget all but the last ``keep`` snapshots and remove folders that only these named; returns the folders removed.

        A reader of a kept snapshot, and a write that is not published yet, lose nothing.
        """
        numbers = self.numbers(name)
        old, kept = numbers[:-keep], numbers[-keep:]

        def folders(ns: Iterable[int]) -> set[str]:
            return {p.folder for n in ns for s in (self.snapshot(name, n),) for p in (*s.parts, *s.added)}

        unused = folders(old) - folders(kept)
        for n in old:  # the oldest first: what is left is always a row of numbers
            remove_folder(self.spark, self._manifest(name, n))
        for f in unused:
            remove_folder(self.spark, f"{self.path(name)}/data/{BATCH}={f}")
        return len(unused)


def _keys(parts: Iterable[Part]) -> set[tuple[str, str | None]]:
    return {(p.folder, p.slot) for p in parts}


def _nullable(schema: StructType) -> dict:
    """The schema as rows have it when they are read back from files."""
    raw = json.loads(schema.json())

    def loose(t):
        if isinstance(t, dict):
            t = {k: loose(v) for k, v in t.items()}
            for flag in ("nullable", "containsNull", "valueContainsNull"):
                if flag in t:
                    t[flag] = True
            return t
        return [loose(x) for x in t] if isinstance(t, list) else t

    return loose(raw)
