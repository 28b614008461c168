"""Text quality by a byte-level convolutional network in numpy.

A document is cut into overlapping chunks that cover it whole. A filter scores each window of
bytes as a sum of learned weights, one for each place and byte value; its largest score in a chunk is kept. The mean and
the maximum over chunks of these, for all filters, give one probability by a logistic layer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import fold, spans_of, text_rows

WIDTH, STRIDE, FILTERS = 8, 2, 16
CHUNK = 512  # window starts in a chunk; a chunk overlaps the next by WIDTH - 1 bytes
# Learning: rows of each class.
SAMPLE_ROWS = 1000
EPOCHS, DOCS_IN_STEP, RATE, DECAY, SEED = 12, 32, 0.01, 1e-4, 5
_CHUNKS_AT_ONCE = 64


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts, filled up with zero bytes, and how many each text has (one at least)."""
    counts = np.asarray([max(1, -(-len(t) // CHUNK)) for t in texts])
    flat = b"".join(t.ljust(int(n) * CHUNK, b"\0") + b"\0" * WIDTH for t, n in zip(texts, counts))
    starts = np.concatenate([
        np.arange(n) * CHUNK + base for n, base in zip(counts, np.cumsum([0, *(counts[:-1] * CHUNK + WIDTH)]))])
    data = np.frombuffer(flat, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK + WIDTH - 1)[starts], counts


class Network:
    def __init__(self, rng: np.random.Generator):
        self.filters = (0.15 * rng.standard_normal((WIDTH, 256, FILTERS))).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.weights = (0.1 * rng.standard_normal(2 * FILTERS)).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.shift, self.weights, self.bias]

    def pooled(self, chunks: np.ndarray, places: bool = False):
        """The largest score of each filter in each chunk, and on demand the window that has it."""
        best = np.empty((len(chunks), FILTERS), np.float32)
        at = np.empty((len(chunks), FILTERS), np.int64) if places else None
        for begin in range(0, len(chunks), _CHUNKS_AT_ONCE):
            part = chunks[begin:begin + _CHUNKS_AT_ONCE]
            scores = self.filters[0].take(part[:, 0:CHUNK:STRIDE], axis=0)
            for j in range(1, WIDTH):
                scores += self.filters[j].take(part[:, j:CHUNK + j:STRIDE], axis=0)
            best[begin:begin + len(part)] = scores.max(1)
            if places:
                at[begin:begin + len(part)] = scores.argmax(1) * STRIDE
        return best + self.shift, at

    def logits(self, pooled: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        active = np.maximum(pooled, 0)
        starts = np.cumsum([0, *counts[:-1]])
        features = np.hstack([np.add.reduceat(active, starts) / counts[:, None], np.maximum.reduceat(active, starts)])
        return features @ self.weights + self.bias[0], features

    def gradients(self, chunks: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        pooled, at = self.pooled(chunks, places=True)
        logits, features = self.logits(pooled, counts)
        slope = ((1 / (1 + np.exp(-logits)) - labels) / len(labels)).astype(np.float32)
        doc = np.repeat(np.arange(len(counts)), counts)
        by_mean, by_max = np.split(slope[:, None] * self.weights, 2, axis=1)
        top = (np.maximum(pooled, 0) == features[doc, FILTERS:]).astype(pooled.dtype)
        top /= np.add.reduceat(top, np.cumsum([0, *counts[:-1]]))[doc]  # chunks that tie share the gradient
        back = (by_mean[doc] / counts[doc, None] + by_max[doc] * top) * (pooled > 0)
        filters = np.zeros_like(self.filters)
        chunk, which = np.arange(len(chunks))[:, None], np.arange(FILTERS)[None, :]
        for j in range(WIDTH):  # only the window that won passes a gradient on
            np.add.at(filters[j], (chunks[chunk, at + j], np.broadcast_to(which, at.shape)), back)
        return [filters, back.sum(0), slope @ features, np.asarray([slope.sum()], np.float32)]

    def score(self, texts: list[bytes]) -> np.ndarray:
        chunks, counts = chunks_of(texts)
        return 1 / (1 + np.exp(-self.logits(self.pooled(chunks)[0], counts)[0].astype(float)))


def fit(texts: list[bytes], labels: list[int], seed: int = SEED, epochs: int = EPOCHS) -> Network:
    """Adam on cross-entropy, both classes weighing the same by turns of equal samples."""
    rng = np.random.default_rng(seed)
    net = Network(rng)
    labels = np.asarray(labels, np.float32)
    sums = [[np.zeros_like(p), np.zeros_like(p)] for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        # The smaller class is drawn again until it is as large.
        good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
        size = max(len(good), len(bad))
        order = rng.permutation(np.concatenate([rng.permutation(np.resize(good, size)), rng.permutation(np.resize(bad, size))]))
        for begin in range(0, len(order), DOCS_IN_STEP):
            own = order[begin:begin + DOCS_IN_STEP]
            chunks, counts = chunks_of([texts[i] for i in own])
            step += 1
            for p, g, (mean, square) in zip(net.parameters(), net.gradients(chunks, counts, labels[own]), sums):
                g = g + DECAY * p
                mean += 0.1 * (g - mean)
                square += 0.001 * (g * g - square)
                p -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return net


def usable_labels(labels: DataFrame, parts: int, held: int) -> DataFrame:
    usable = labels.filter("doc_id is not null and quality in (0, 1)").filter(fold("doc_id", parts) != held)
    return usable.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))


def sample(docs: DataFrame, usable: DataFrame, rows: int) -> list[tuple[int, bytes, int]]:
    """A bounded sample of labelled texts, the same whatever the order of rows."""
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    # No text is read to draw, and texts of all lengths are taken.
    drawn = usable.filter("quality = 0").distinct().orderBy(*order).limit(rows).union(
        usable.filter("quality = 1").distinct().orderBy(*order).limit(rows))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = texts.filter(F.col("text").isNotNull())
    found = texts.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id", "quality"])
    return sorted((r.doc_id, bytes(r.text), r.quality) for r in found.select("doc_id", "text", "quality").collect())


def _predict(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            if isinstance(shared.value, float):
                scores = np.full(len(texts), shared.value)
            else:
                scores = np.concatenate([np.zeros(0), *(
                    shared.value.score(texts[a:b]) for a, b in spans_of([len(t) + CHUNK for t in texts], 1 << 21))])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                pa.array((scores >= 0.5).astype(np.int32))], schema=schema)

    return predict


def classify(
    docs: DataFrame, labels: DataFrame, *, parts: int = 3, held: int = 1,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every whole text.

    Learns from at most ``sample_rows`` documents of each class of ``labels.quality`` whose crc32(doc_id) mod ``parts``
    is not ``held``, whole texts of any length; fitting is the one step on the driver, over that sample. Filters start at every second byte.
    The shares of the classes come from all labels of these folds. Where a class is missing, the score is the share of label 1, drawn towards one half. Null and empty texts
    are scored as a chunk of zero bytes. Labels that are null or neither 0 nor 1 are not used. Repeated
    rows and rows without doc_id are scored each; other columns are not read. An empty table gives no rows.
    """
    usable = usable_labels(labels, parts, held)
    shares = {r.quality: r.n for r in usable.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    learned = sample(docs, usable, sample_rows)
    found = [quality for _, _, quality in learned]
    if len(set(found)) < 2:
        model: Network | float = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)
    else:
        model = fit([t for _, t, _ in learned], found)
        model.bias += np.float32(np.log(shares[1] / shares[0]))  # learned on classes of equal size
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    rows = text_rows(docs, ids, (fold("doc_id", parts) == held).alias("held_out"))
    return rows.mapInArrow(_predict(shared), "doc_id bigint, held_out boolean, score double, predicted int")
