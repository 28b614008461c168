"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit integers make all signature coordinates: every shingle goes
through the first once, and coordinate j is the smallest value of the second permutation
shifted circularly by j places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import (
    components, mix64, rolling_hashes, runs, smallest_reachable, stored, text_rows, with_small_batches, word_hashes,
)

SHINGLE_WORDS = 4
PERCENT = 80
# 25 bands of 5: a pair at a similarity of 0.8 meets in a band with probability 0.99995.
BANDS, BAND_ROWS = 25, 5
# Shingles permuted at a time, so that the working arrays stay in a core's cache.
_BLOCK = 1 << 15
# Documents, and shingles of these, that are compared with each other in one go.
GROUP_DOCS, GROUP_SHINGLES = 1024, 1 << 19
# So many identifiers with their 16-byte keys, some 50 MB, may be broadcast.
BROADCAST_IDS = 1_000_000


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    if not text:
        return np.empty(0, np.uint64)
    return np.unique(rolling_hashes(word_hashes(text.lower().split()), width))


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _second_permutation(x: np.ndarray, spare: np.ndarray) -> None:
    """A bijection of the 32-bit integers, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    np.bitwise_xor(x, spare, out=x)


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` coordinates for each non-empty shingle set."""
    out = np.empty((len(sets), size), np.uint32)
    begin = 0
    while begin < len(sets):
        end, total = begin + 1, len(sets[begin])
        while end < len(sets) and total + len(sets[end]) <= _BLOCK:
            total += len(sets[end])
            end += 1
        # The first permutation, on the low half of a 64-bit bijection's input range.
        placed = (mix64(np.concatenate(sets[begin:end])) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, sets[begin:end - 1])])
        shifted, spare = np.empty_like(placed), np.empty_like(placed)
        for j in range(size):
            np.subtract(placed, np.uint32(j), out=shifted)
            _second_permutation(shifted, spare)
            out[begin:end, j] = np.minimum.reduceat(shifted, starts)
        begin = end
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    state = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    cells = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    for r in range(rows):
        state = mix64(state * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, r])
    return state.view(np.int64)


def _sign(width: int, bands: int, rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                        ("bands", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            found = iter(band_hashes(signatures(full, bands * rows), bands, rows)) if full else iter(())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(found) if len(s) else [] for s in sets], pa.list_(pa.int64())),
            ], schema=schema)

    return sign


def _sets(width: int):
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "text"))):
                shingles = shingle_set(text, width)
                if set_key(shingles) == key:  # else another text under the same doc_id
                    rows.append((doc, shingles.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.list_(pa.int64()))], schema=schema)

    return sets


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sets of distinct numbers."""
    count, common = len(sets), 32
    doc = np.repeat(np.arange(count), [len(s) for s in sets])
    order = np.argsort(values := np.concatenate(sets), kind="stable")
    values, doc = values[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    holders = np.diff(np.concatenate([first, [len(values)]]))
    column = np.repeat(np.arange(len(first)), holders)
    often = holders > common
    out = np.zeros(count * count, np.int64)
    # A shingle of many documents is a column of a matrix, others are paired up one distance at a time.
    dense, place = np.flatnonzero(often), np.cumsum(often) - 1
    total = np.zeros((count, count), np.float32)
    for begin in range(0, len(dense), 4096):
        own = often[column] & (place[column] >= begin) & (place[column] < begin + 4096)
        matrix = np.zeros((count, min(4096, len(dense) - begin)), np.float32)
        matrix[doc[own], place[column[own]] - begin] = 1
        total += matrix @ matrix.T
    few = ~often[column]
    doc, column = doc[few], column[few]
    for apart in range(1, common):
        same = np.flatnonzero(column[apart:] == column[:-apart])
        if not len(same):
            break
        out += np.bincount(doc[same] * count + doc[same + apart], minlength=count * count)
    out = out.reshape(count, count)
    return out + out.T + np.rint(total).astype(np.int64)


def _join_groups(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ("band", "low", "high")):
            ids = run.column("a").to_numpy()
            order = np.argsort(ids)
            ids, of = ids[order], run.column("of_a").to_numpy()[order]
            sets = run.column("shingles").combine_chunks()
            values, ends = sets.flatten().to_numpy(), np.cumsum(sets.value_lengths().to_numpy())
            sets = [values[ends[i - 1] if i else 0:ends[i]] for i in order]
            sizes = np.asarray([len(s) for s in sets])
            both = intersections(sets)
            linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
            x, y = np.nonzero(np.triu(linked & (of[:, None] != of[None, :]), 1))
            root = smallest_reachable(x, y, len(ids))
            used = np.flatnonzero(root != np.arange(len(ids)))
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(ids[used]), pa.array(ids[root[used]])], schema=schema)

    return join_groups


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their sets of word
    shingles (64-bit hashes). Equal sets count as one class. In each bucket of a band every class is
    compared with the smallest one. Where a bucket then holds classes of different components, those
    that the triangle inequality of the Jaccard distance does not rule out meet again, in blocks whose
    intersections are counted at once in one task; what leaves the task is a spanning forest, never pairs. So a group of
    copies costs a comparison each, and no link found by banding that could join two components is left out.

    Null, empty or blank text: no shingles, linked with nothing. A null doc_id is linked with
    nothing, has a null component and is kept. Repeated rows of one doc_id are one document and get a row each; of
    different texts under one doc_id one is compared.
    Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    signed = stored(
        text_rows(docs, ids).mapInArrow(
            _sign(shingle_words, bands, band_rows),
            "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"), "signed")
    known = signed.filter("set_key is not null and doc_id is not null")
    twice = stored(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "repeated")
    repeated = not twice.isEmpty()
    if repeated:  # of several sets of one document the one with the smallest key
        once = known.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(
            F.min(F.struct("set_key", "n_shingles", "bands")).alias("s")).select("doc_id", "s.n_shingles", "s.set_key", "s.bands")
        known = known.join(twice, "doc_id", "left_anti").unionByName(once)
    classes = stored(
        known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    members = classes.select("rep", "n", F.col("set_key").alias("key"), F.explode("bands").alias("band"))
    leaders = stored(
        members.groupBy("band").agg(F.min(F.struct("rep", "n", "key")).alias("leader"), F.count(F.lit(1)).alias("c"))
        .filter("c > 1").select("band", F.col("leader.rep").alias("b"), F.col("leader.n").alias("n_b"),
                                F.col("leader.key").alias("key_b")), "leaders")
    in_buckets = stored(
        members.join(leaders, "band").withColumnsRenamed({"rep": "a", "n": "n_a", "key": "key_a"}), "in-buckets")
    # Full shingle sets of the classes that share a bucket with another; texts are shuffled at most this once.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("binary").alias("text"))
    shared = in_buckets.select(F.col("a").alias("id"), F.col("key_a").alias("key")).distinct()
    shared = stored(shared, "shared")
    if shared.count() <= BROADCAST_IDS:  # else both sides are shuffled
        shared = F.broadcast(shared)

    def sets_of(rows: DataFrame) -> DataFrame:
        return with_small_batches(shared.join(rows, "id")).mapInArrow(_sets(shingle_words), "id bigint, shingles array<bigint>")

    if repeated:  # a set counts once, however many rows have it
        ids_twice = twice.withColumnRenamed("doc_id", "id")
        sets = sets_of(texts.join(ids_twice, "id", "left_anti")).union(
            sets_of(texts.join(ids_twice, "id", "left_semi").distinct()).dropDuplicates(["id"]))
    else:
        sets = sets_of(texts)
    sets = stored(sets, "sets")
    possible = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    pairs = in_buckets.filter("a <> b").filter(possible).select("a", "b", "n_a", "n_b").distinct()
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    verified = stored(
        pairs.join(sets.withColumnsRenamed({"id": "a", "shingles": "shingles_a"}), "a")
        .join(sets.withColumnsRenamed({"id": "b", "shingles": "shingles_b"}), "b")
        .select("a", "b", both.cast("bigint").alias("both"), (F.col("n_a") + F.col("n_b") - both).alias("either")), "verified")
    linked = f"100 * both >= {percent} * either"
    edges = verified.filter(linked).select("a", "b")
    labels = components(edges)

    # Classes of one bucket that are not in the component of its leader.
    of_a = labels.withColumnsRenamed({"node": "a", "component": "of_a"})
    of_b = labels.withColumnsRenamed({"node": "b", "component": "of_b"})
    placed = stored(
        in_buckets.join(verified, ["a", "b"], "left").join(of_a, "a", "left").join(of_b, "b", "left")
        .select(
            "band", "a", "n_a", F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b"),
            F.expr("a = b or both is not null").alias("exact"),
            F.expr("case when a = b then 0e0 else 1e0 - coalesce(both / either, "
                   "least(n_a, n_b) / greatest(n_a, n_b)) end").alias("distance")), "placed")
    apart = stored(placed.filter("of_a <> of_b").groupBy("band").agg(F.min("distance").alias("nearest")), "apart")
    if not apart.isEmpty():
        reach = 1 - percent / 100 + 1e-9
        loose = stored(
            placed.join(apart, "band").filter(f"of_a <> of_b or not exact or distance >= nearest - {reach}")
            .select("band", "a", "n_a", "of_a"), "loose")
        groups = stored(
            loose.groupBy("band").agg(
                F.ceil(F.greatest(F.count(F.lit(1)) / GROUP_DOCS, F.sum("n_a") / GROUP_SHINGLES)).alias("blocks")), "groups")
        dealt = (
            loose.select("band", "a", "of_a").join(groups, "band").join(sets.withColumnRenamed("id", "a"), "a")
            .withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
            .select("band", "a", "of_a", "shingles", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
            .repartition("band", "low", "high").sortWithinPartitions("band", "low", "high"))
        more = stored(with_small_batches(dealt).mapInArrow(_join_groups(percent), "a bigint, b bigint"), "more")
        if not more.isEmpty():
            labels = components(edges.union(more))

    grouped = classes.select("set_key", F.col("rep").alias("node")).join(labels, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component"))
    found = signed.select("doc_id", "n_shingles", "set_key").join(grouped, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    return found.select("doc_id", "n_shingles", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one with the smallest doc_id.

    Of repeated rows of a doc_id one stays. Rows without doc_id all stay. Columns stay as they are.
    """
    kept = near_duplicates(docs, **options).filter("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    own = docs.filter("doc_id is not null").join(kept, F.col("doc_id") == F.col("_kept"), "left_semi").dropDuplicates(["doc_id"])
    return own.union(docs.filter("doc_id is null"))
