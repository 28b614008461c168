"""Hard negatives of embedding anchors by the threshold algorithm over per-dimension sorted lists."""

from __future__ import annotations

import math
from collections.abc import Sequence
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import stored

POSITIVES = 5
NEGATIVES = 5
# A negative has at least this share of the positive's score, in percent.
FLOOR_PERCENT = 80
# Components become floor(SCALE * x).
SCALE = 256
# Candidates that one task sorts and anchors that meet them there, at most (on average).
LEAST_BLOCK = 2048
BLOCK = 16384
ANCHOR_BLOCK = 16384
SEED = 5
# Rows read from each list before the threshold is first looked at; doubled after each look.
FIRST_DEPTH = 8
_LONG = 2**63 - 1

Found = list[tuple[int, int]]


def threshold_search(
    vectors: np.ndarray, lists: np.ndarray, anchor: np.ndarray, allowed: np.ndarray,
    windows: Sequence[tuple[int | None, int | None]], ids: np.ndarray, most: int,
) -> list[Found]:
    """For each window (lowest and highest score, None: open), the ``most`` best allowed rows in it as (score, id).

    ``lists`` has for each dimension the rows in ascending order. Dimensions with a positive component of the anchor are read from the
    top, those with a negative one from the bottom, so a row not read yet scores at most the sum over
    dimensions of component times the last value read: the threshold. Rows are scored when first read. Reading stops
    once the threshold is strictly below the ``most``-th best score of every window, or below all that a window takes (a tie with it
    could still have a smaller id), or once all allowed rows are read.
    """
    rows = len(vectors)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    highest = None if any(high is None for _, high in windows) else max(high for _, high in windows)
    unread, left = allowed.copy(), int(np.count_nonzero(allowed))
    scores, places = [vectors[:0] @ anchor], [np.zeros(0, np.int64)]
    depth, step = 0, FIRST_DEPTH
    while left:
        to = min(rows, depth + step)
        if not len(up) and not len(down):
            to, fresh = rows, np.flatnonzero(unread)  # every score is zero
        else:
            read = np.zeros(rows, bool)
            read[lists[:, rows - to:rows - depth][up]] = True
            read[lists[:, depth:to][down]] = True
            fresh = np.flatnonzero(read & unread)
        unread[fresh] = False
        left -= len(fresh)
        scores.append(vectors[fresh] @ anchor)
        places.append(fresh)
        if not left:
            break
        threshold = vectors[lists[up, rows - to], up] @ anchor[up] + vectors[lists[down, to - 1], down] @ anchor[down]
        if highest is None or threshold < highest:  # else no window can be settled
            so_far = np.concatenate(scores)
            if all(_settled(so_far, window, threshold, most) for window in windows):
                break
        depth, step = to, 2 * step
    found, at = np.concatenate(scores), np.concatenate(places)
    return [_best(found, ids[at], window, most) for window in windows]


def _inside(scores: np.ndarray, window: tuple[int | None, int | None]) -> np.ndarray:
    low, high = window
    inside = np.ones(len(scores), bool)
    if low is not None:
        inside &= (scores >= low).astype(bool)
    if high is not None:
        inside &= (scores <= high).astype(bool)
    return inside


def _settled(scores: np.ndarray, window: tuple[int | None, int | None], threshold, most: int) -> bool:
    if window[0] is not None and threshold < window[0]:
        return True
    own = scores[_inside(scores, window)]
    return len(own) >= most and bool(threshold < np.partition(own, -most)[-most])


def _best(scores: np.ndarray, ids: np.ndarray, window: tuple[int | None, int | None], most: int) -> Found:
    inside = _inside(scores, window)
    own, names = scores[inside], ids[inside]
    if len(own) > most:
        top = (own >= np.partition(own, -most)[-most]).astype(bool)
        own, names = own[top], names[top]
    best = nsmallest(most, zip((-int(s) for s in own), names.tolist()))
    return [(-s, i) for s, i in best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), float).reshape(len(column), len(column[0].as_py()))


def _sorted_lists(vectors: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.argsort(vectors, 0, kind="stable").T)


def _exact(anchors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where all their sums are exact, else as Python integers."""
    widest = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * anchors.shape[1]
    if widest < 2.0**53:
        return anchors, rows
    whole = np.vectorize(int, otypes=[object])
    return whole(anchors) if anchors.size else anchors, whole(rows) if rows.size else rows


def _stored_score(score: int) -> int:
    return max(-_LONG, min(_LONG, score))


def _own_label(most: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])

    def search(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            own, matrix = _exact(_matrix(anchors["vec"]), _matrix(rows["vec"]))
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            by_label: dict[int, tuple] = {}
            for anchor, name, label in zip(own, anchors["vec_id"].to_pylist(), anchors["label"].to_pylist()):
                if label not in by_label:
                    part = np.flatnonzero(labels == label)
                    by_label[label] = matrix[part], _sorted_lists(matrix[part]), ids[part]
                vectors, lists, names = by_label[label]
                for score, other in threshold_search(vectors, lists, anchor, names != name, [(None, None)], names, most)[0]:
                    out.append((name, other, _stored_score(score)))
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], schema=schema)

    return search


def _other_labels(most: int, percent: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_score", pa.int64()), ("negative_id", pa.int64()),
                        ("negative_score", pa.int64())])

    def search(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            own, matrix = _exact(_matrix(anchors["vec"]), _matrix(rows["vec"]))
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            lists = _sorted_lists(matrix)
            for anchor, name, label, scores in zip(
                    own, anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), anchors["scores"].to_pylist()):
                windows = [(-(-percent * s // 100), s) for s in scores]
                allowed = (labels != label) & (ids != name)
                for s, found in zip(scores, threshold_search(matrix, lists, anchor, allowed, windows, ids, most)):
                    out.extend((name, s, other, _stored_score(score)) for score, other in found)
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], [], []))], schema=schema)

    return search


def _meet(anchors: DataFrame, rows: DataFrame, counts: tuple[int, int], search, schema: str) -> DataFrame:
    """Every block of anchors meets every block of rows, each pair of blocks in a task of its own."""
    blocks, anchor_blocks = counts
    cell = ["size", "row_block", "anchor_block"]

    def number(name: str, of: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(of)).alias(name)

    def each(name: str, of: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(of - 1).cast("bigint"))).alias(name)

    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of its own beside those of rows
    left = anchors.select("*", F.size("vec").alias("size"), number("anchor_block", anchor_blocks), each("row_block", blocks))
    right = rows.select("*", F.size("vec").alias("size"), number("row_block", blocks), each("anchor_block", anchor_blocks))
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(search, schema)


def _first(found: DataFrame, group: Sequence[str], score: str, name: str, most: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col(score).desc(), name)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(
    embeddings: DataFrame, anchor: Column, *, positives: int = POSITIVES, negatives: int = NEGATIVES,
    floor_percent: int = FLOOR_PERCENT, scale: int = SCALE, block: int | None = None, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for all rows where ``anchor`` holds.

    Scores are exact integer inner products of components floor(``scale`` * x); higher ones come first, ties by smaller
    vec_id. An anchor's positives are its first ``positives`` other rows of the same label; each gets the first
    ``negatives`` rows of another label that score ``floor_percent`` percent of it at least and no more than it.

    Rows and anchors are dealt by hash into blocks of bounded size, whatever labels they have; each pair of blocks is searched by
    the threshold algorithm in one task, and only the best rows of each window leave it.

    Rows with a null vec_id, label or vector, or with a null or non-finite component (also after scaling), take no part. Of rows with one vec_id the
    smallest by label and vector stays. Vectors of different lengths do not meet; empty ones score 0. A score beyond the range of a long is
    compared exactly for negatives and returned as the end of the range. Other columns are not read; an empty table gives no rows.
    """
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    rows = stored(
        embeddings.select(
            F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
            F.col("embedding").cast("array<double>").alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
        # A double holds the floor of every double; the built-in floor would give a long.
        .withColumn("vec", F.transform("vec", lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale)))
        .groupBy("vec_id").agg(F.min(F.struct("label", "vec", "anchor")).alias("row")).select("vec_id", "row.*"), "negatives")
    anchors = rows.filter("anchor").drop("anchor")
    rows = rows.drop("anchor")
    total = rows.count()
    # Small tables are cut finer, so that there is work for all executors.
    block = block or max(LEAST_BLOCK, min(BLOCK, math.ceil(total / 64)))
    counts = max(1, math.ceil(total / block)), max(1, math.ceil(anchors.count() / anchor_block))

    near = _meet(anchors, rows, counts, _own_label(positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    chosen = stored(_first(near, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"), "positives")
    wanted = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("scores"))
    hard = _meet(
        anchors.join(wanted, "vec_id"), rows, counts, _other_labels(negatives, floor_percent),
        "anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    ranked = _first(hard, ["anchor_id", "positive_score"], "negative_score", "negative_id", negatives)
    return chosen.join(ranked, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
