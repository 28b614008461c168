"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.keys import _OPENED, stored_once
from tillstar.session import remove_folder

# Rows in one Arrow batch: a batch of very long texts then still fits a Python worker.
BATCH_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: a cut in the lineage that survives lost executors."""
    return stored_once(df, f"llm/{label}")


def stored_alone(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Store what ``build`` returns and remove the tables that it stored on the way there, and its shuffle files.

    Spark removes shuffle files once the driver has collected what refers to them, which a driver with little to do
    puts off; so it is asked to.
    """
    steps: list[str] = []
    token = _OPENED.set(steps)
    try:
        df = build()
    finally:
        _OPENED.reset(token)
    kept = stored(df, label)
    for path in steps:
        remove_folder(spark, path)
    del df
    spark._jvm.System.gc()
    return kept


def with_small_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of a text table (a session setting, only ever lowered)."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what is written inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_rows(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns and the text as UTF-8 bytes, ready for ``mapInArrow``."""
    return with_small_batches(docs.select(*columns, F.col("text").cast("binary").alias("text")))


def one_row_each(rows: DataFrame) -> DataFrame:
    """``doc_id, text`` with one row for each doc_id: of several texts the smallest, nulls last.

    Only identifiers are shuffled to find the repeated ones; texts are where an identifier is repeated, and there copies are combined on the
    map side.
    """
    twice = stored(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "repeated")
    if twice.isEmpty():
        return rows
    once = rows.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return rows.join(twice, "doc_id", "left_anti").unionByName(once)


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the identifier as text, modulo ``parts``; a missing identifier counts as 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def spans_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes sum to ``most`` at most; a larger one stands alone."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers (finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` neighbours; for fewer, one hash of the whole sequence."""
    if not len(hashes):
        return hashes
    count = max(1, len(hashes) - width + 1)
    state = np.zeros(count, np.uint64)
    for j in range(min(width, len(hashes))):
        state = mix64(state * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + count])
    return state


def runs(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Whole groups of equal keys from batches that are sorted by these non-null keys."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        first = tuple(c[0] for c in columns)
        for i in range(len(starts) - 1):
            piece = batch.slice(starts[i], starts[i + 1] - starts[i])
            if i or (held and first != last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def smallest_reachable(x: np.ndarray, y: np.ndarray, count: int) -> np.ndarray:
    """For nodes 0..count-1 and links x[i]-y[i], the smallest node each can reach."""
    root = np.arange(count)
    while True:
        near = root.copy()
        np.minimum.at(near, x, root[y])
        np.minimum.at(near, y, root[x])
        near = near[near]
        if (near == root).all():
            return root
        root = near


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges ``a``, ``b``: every node with the smallest node it reaches.

    Each round points every node at its smallest neighbour, follows pointers by doubling to
    their ends and contracts the edges. A star takes one round, and so does a path in order of its nodes, with a
    doubling for each power of two of its length. Rounds work on stored tables, only whether rows are left
    reaches the driver, and both sides of every join have an exchange of their own, so a hub with many
    edges can be split.
    """
    left = stored(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to")), "up")
        while True:
            further = up.filter("to < node").select(F.col("node").alias("to"), F.col("to").alias("next"))
            if up.join(further, "to").isEmpty():
                break
            up = stored(up.join(further, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "up")
        if labels is None:
            labels = up.withColumnRenamed("to", "component")
        else:
            labels = stored(
                labels.join(up.withColumnRenamed("node", "component"), "component", "left")
                .select("node", F.coalesce("to", "component").alias("component")), "labels")
        left = stored(
            left.join(up.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(up.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .filter("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
