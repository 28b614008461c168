"""Near-duplicate embeddings: random-hyperplane sign hashing, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import components, runs, smallest_reachable, stored, with_small_batches

THRESHOLD = 0.93
SEED = 11
# A linked pair is missed with this probability at most.
MISS = 1e-4
# Unrelated vectors that share a bucket of a table, on average.
BUCKET = 32
# Vectors compared with each other in one go; larger buckets are split into blocks of it.
BLOCK = 512


def tables_for(count: int, threshold: float, miss: float, bucket: int) -> tuple[int, int]:
    """Sign bits of a table, and the number of tables.

    Bits grow with the logarithm of the number of vectors, so buckets of unrelated vectors keep
    their size; two vectors at the threshold agree in a bit with probability 1 - angle / pi, and
    tables are added until they agree in one but for the accepted miss.
    """
    bits = max(4, math.ceil(math.log2(max(1, count) / bucket))) if count > bucket else 4
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree)))


def planes(seed: int, table: int, bits: int, size: int) -> np.ndarray:
    return np.random.default_rng([seed, table, size]).standard_normal((size, bits))


def _hash(tables: int, bits: int, seed: int):
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("vec", pa.list_(pa.float64())),
                        ("vec_key", pa.binary()), ("codes", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            vectors = [np.asarray(v, float) + 0.0 for v in batch.column("vec").to_pylist()]  # -0.0 becomes 0.0
            codes = np.empty((len(vectors), tables), np.int64)
            sizes = np.asarray([len(v) for v in vectors])
            for size in set(sizes.tolist()):
                own = np.flatnonzero(sizes == size)
                matrix = np.stack([vectors[i] for i in own])
                matrix /= np.abs(matrix).max(1, keepdims=True)
                for t in range(tables):
                    codes[own, t] = (matrix @ planes(seed, t, bits, size) > 0) @ weights
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), pa.array(vectors, pa.list_(pa.float64())),
                pa.array([xxhash.xxh3_128_digest(v.tobytes()) for v in vectors], pa.binary()),
                pa.array(list(codes), pa.list_(pa.int64()))], schema=schema)

    return sign


def _link(threshold: float):
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ("bucket", "low", "high")):
            rep = run.column("rep").to_numpy()
            order = np.argsort(rep)
            rep = rep[order]
            copies = run.column("copies").to_numpy()[order]
            block = run.column("block").to_numpy()[order]
            codes = np.asarray(run.column("codes").to_pylist())[order]
            vectors = np.asarray(run.column("vec").to_pylist())[order]
            table, low, high = (run.column(c)[0].as_py() for c in ("table", "low", "high"))
            vectors /= np.abs(vectors).max(1, keepdims=True)
            vectors /= np.sqrt((vectors * vectors).sum(1, keepdims=True))
            linked = vectors @ vectors.T >= threshold
            np.fill_diagonal(linked, False)
            if low != high:  # pairs within a block are counted where the block meets itself
                linked &= block[:, None] != block[None, :]
            x, y = np.nonzero(linked)
            # A pair counts in the first table in which it shares a bucket.
            new = np.ones(len(x), bool)
            for t in range(table):
                new &= codes[x, t] != codes[y, t]
            links = np.bincount(x[new], copies[y[new]], len(rep)).astype(np.int64)
            root = smallest_reachable(x, y, len(rep))
            used = np.flatnonzero((links > 0) | (root != np.arange(len(rep))))
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[used]), pa.array(links[used]), pa.array(rep[root[used]])], schema=schema)

    return link


def near_duplicates(
    embeddings: DataFrame,
    *,
    threshold: float = THRESHOLD,
    miss: float = MISS,
    bucket: int = BUCKET,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``.

    Vectors of one label (and one length) link at a cosine of ``threshold`` or more, computed in double precision.
    Equal vectors are one class with a number of copies. A bucket of a hash table is cut into blocks, and
    each pair of blocks is one matrix product in one task: counts and a spanning
    forest leave it, never pairs. ``n_links`` counts rows, so repeated rows are each other's links.

    Null, empty or zero vectors, those with null or non-finite components, and those without label or vec_id
    link with nothing and are kept, as their own component. Other columns are not read. An empty table gives no rows.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False)))
    bits, tables = tables_for(rows.count(), threshold, miss, bucket)
    hashed = stored(
        with_small_batches(rows.filter(usable)).mapInArrow(
            _hash(tables, bits, seed),
            "vec_id bigint, label bigint, vec array<double>, vec_key binary, codes array<bigint>"), "hashed")
    classes = stored(
        hashed.groupBy("label", "vec_key").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
            F.first(F.struct("vec", "codes")).alias("v")).select("label", "vec_key", "rep", "copies", "v.vec", "v.codes"),
        "classes")
    place = classes.select("*", F.posexplode("codes").alias("table", "code")).withColumn(
        "bucket", F.xxhash64("label", F.size("vec"), "table", "code")).drop("code")
    sizes = stored(place.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    blocks = F.ceil(F.col("n") / block)
    dealt = (
        place.select("bucket", "table", "rep", "copies", "vec", "codes").join(sizes, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(seed)), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("n", "other").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high"))
    found = stored(
        with_small_batches(dealt).mapInArrow(_link(threshold), "rep bigint, links bigint, root bigint"), "found")
    labels = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    answer = stored(
        classes.select("label", "vec_key", "rep", "copies").join(counts, "rep", "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "vec_key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "answer")
    known = hashed.select("vec_id", "label", "vec_key").join(answer, ["label", "vec_key"]).select(
        "vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
