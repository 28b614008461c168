"""Shuffled shards of a corpus by a two-pass external shuffle, on built-in expressions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import stored

SHARDS = 16
SEED = 20240607
# Target of UTF-8 text in one bucket, which one task holds and shuffles in memory.
BUCKET_BYTES = 4 << 20
_BUCKETS_IN_TASK = 8
# Offsets of so many buckets, two numbers each, are small enough to broadcast.
BROADCAST_BUCKETS = 1_000_000


def two_pass_shuffle(docs: DataFrame, *, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``docs`` with ``shard`` (int, 0..shards-1) and ``slot`` (long, gapless from 0).

    First pass: a seeded hash of the row's digest scatters rows uniformly over as many buckets
    as it takes to keep a bucket near ``bucket_bytes``. Exact repeats of a row are spread by their
    scan position, so copies that make up a third of the table do not meet in one bucket. Second pass: each bucket is ordered by its hash, shuffled by
    Fisher-Yates (the built-in ``shuffle``) and dealt out. A row's place in the whole order is the
    sum of the sizes of earlier buckets plus its place in its own; ``place mod shards`` is the
    shard, so shard counts differ by one at most. Only bucket counts are summed in one place.

    ``docs`` should be a table scan (a position is then the same when a task is retried). Null columns, empty
    and very long texts are carried as they are. Columns of the input named ``shard``
    or ``slot`` are replaced. An empty table gives no rows.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    total = docs.agg(F.sum(size.cast("bigint")).alias("total")).first().total or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    carried = [c for c in docs.columns if c not in ("shard", "slot")]
    ticket = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"), F.monotonically_increasing_id())
    dealt = docs.select(F.struct(ticket.alias("ticket"), F.struct(*[F.col(f"`{c}`") for c in carried]).alias("fields")).alias("row"))
    scattered = (
        dealt.select(F.pmod(F.col("row.ticket"), F.lit(buckets)).cast("int").alias("bucket"), "row")
        .repartition(math.ceil(buckets / _BUCKETS_IN_TASK), "bucket"))
    shuffled = stored(
        scattered.groupBy("bucket").agg(F.collect_list("row").alias("rows"))
        .select("bucket", F.posexplode(F.shuffle(F.array_sort("rows"), seed)).alias("at", "row"))
        .select("bucket", "at", "row.fields"), "buckets")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        shuffled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        # one row for each bucket_bytes of the corpus
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    if buckets <= BROADCAST_BUCKETS:  # else the join is left to the optimizer
        offsets = F.broadcast(offsets)
    place = F.col("first") + F.col("at")
    return shuffled.join(offsets, "bucket").select(
        *[F.col("fields").getField(c).alias(c) for c in carried], (place % shards).cast("int").alias("shard"),
        F.floor(place / shards).cast("bigint").alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
