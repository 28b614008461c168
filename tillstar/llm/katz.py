"""Katz backoff language model over words: Good-Turing discounts, exactly normalised backoff weights.

The model is a bigram over words, whose contexts are the words before. Counts are partitioned by word: a
bucket holds all counts of its words, in any context, hence also the words' own counts. Backoff weights are a stored table with a
row for each context. A word is itself the context of what follows it, so its bucket also gets its weight as a context, and only pairs
that were not seen meet the weights of their contexts in a join. Counts and requests travel as compressed columns of many entries, one
row for each bucket and chunk of documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import batches_of, fold, mix64, runs, stored, text_rows, word_hashes

# A context is told by all bits of the word before it.
CELL_BITS = 64
# Counts up to this one are discounted.
MOST_DISCOUNTED = 5
# Text that makes one bucket of words, and tokens that a task gathers before it sends them on.
BUCKET_BYTES, CHUNK_TOKENS = 64 << 20, 1 << 21
# Rows of compressed columns, each up to a megabyte, in one Arrow batch.
BLOB_ROWS = 32
# Rows of one number each in one Arrow batch.
SCALE_ROWS = 65_536
# Chunks whose entries of one bucket meet in one task. With more of them, a bucket (and a word as frequent as all others of it together)
# is dealt to several tasks by chunk.
CHUNKS_TOGETHER = 64
# Stand for the end and the begin of a text: no word holds a blank.
END, BEGIN = (xxhash.xxh64_intdigest(x) for x in (b" end", b" begin"))
ADDED = 0.1
# Bytes of a token and the white space after it, about: to tell how many chunks there will be.
_TOKEN_BYTES = 6


def squeeze(values: np.ndarray) -> bytes:
    """A column of numbers, byte planes first, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(planes.tobytes(), 3)


def expand(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def tokens_of(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text, ASCII letters lowered, and of its end."""
    return mix64(np.append(word_hashes((text or b"").lower().split()), np.uint64(END)))


def begin() -> np.uint64:
    """The context of a text's first token."""
    return mix64(np.asarray([BEGIN], np.uint64))[0]


def cells_of(tokens: np.ndarray) -> np.ndarray:
    """The context of each token: the word before it, or the begin."""
    return np.concatenate([[begin()], tokens[:-1]])


@dataclass
class Chunk:
    """Documents gathered in a task: their tokens, contexts and rows."""

    tokens: list[np.ndarray] = field(default_factory=list)
    cells: list[np.ndarray] = field(default_factory=list)
    docs: list[int | None] = field(default_factory=list)
    held: list[bool] = field(default_factory=list)
    total: int = 0

    def add(self, doc: int | None, held: bool, text: bytes | None) -> None:
        tokens = tokens_of(text)
        self.tokens.append(tokens)
        self.cells.append(cells_of(tokens))
        self.docs.append(doc)
        self.held.append(held)
        self.total += len(tokens)

    def entries(self, by_doc: bool) -> tuple[np.ndarray, ...]:
        """Distinct (word, context) or (word, context, row), sorted, with counts: words, entries of each, all contexts, and of each
        entry the place of its context, row and count."""
        words, at = np.unique(np.concatenate(self.tokens), return_inverse=True)
        names, cells = np.unique(np.concatenate(self.cells), return_inverse=True)
        bits = np.uint64(len(names).bit_length())
        key = at.astype(np.uint64) << bits | cells.astype(np.uint64)
        rows = np.zeros(0, np.uint32)
        if by_doc:
            row = np.repeat(np.arange(len(self.docs), dtype=np.uint64), [len(t) for t in self.tokens])
            pairs, pair = np.unique(key, return_inverse=True)
            own = np.uint64(max(1, len(self.docs)).bit_length())
            key, counts = np.unique(pair.astype(np.uint64) << own | row, return_counts=True)
            rows, key = (key & ((np.uint64(1) << own) - np.uint64(1))).astype(np.uint32), pairs[(key >> own).astype(np.int64)]
        else:
            key, counts = np.unique(key, return_counts=True)
        sizes = np.bincount((key >> bits).astype(np.int64), minlength=len(words)).astype(np.uint32)
        return words, sizes, names, (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.uint32), rows, counts.astype(np.uint32)


_ENTRIES = [("words", np.uint64), ("sizes", np.uint32), ("names", np.uint64), ("cells", np.uint32), ("rows", np.uint32),
            ("counts", np.uint32)]
_SENT = ("bucket int, chunk bigint, words binary, sizes binary, names binary, cells binary, rows binary, counts binary, "
         "docs binary, flags binary")
_SENT_SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64())]
                         + [(n, pa.binary()) for n in (*(n for n, _ in _ENTRIES), "docs", "flags")])


def _steps(values: np.ndarray) -> np.ndarray:
    """Sorted identifiers as the steps between them."""
    return np.diff(values, prepend=np.uint64(0))


def _send(chunk: Chunk, number: int, buckets: int, by_doc: bool) -> Iterator[pa.RecordBatch]:
    words, sizes, names, cells, rows, counts = chunk.entries(by_doc)
    # Words are sorted by their hash, so a bucket is a range of them.
    bucket = ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    for b in np.flatnonzero(np.diff(cut)):
        lo, hi = cut[b], cut[b + 1]
        a, z = ends[lo], ends[hi]
        own = rows[a:z]
        local = np.zeros(0, np.uint32)
        if by_doc:  # only documents with words in this bucket are named
            local, own = np.unique(own, return_inverse=True)
        met, place = np.unique(cells[a:z], return_inverse=True)
        docs = np.asarray([chunk.docs[i] or 0 for i in local], np.int64)
        flags = np.asarray([chunk.held[i] + 2 * (chunk.docs[i] is None) for i in local], np.uint8)
        yield pa.RecordBatch.from_arrays([
            pa.array([b], pa.int32()), pa.array([number], pa.int64()),
            *(pa.array([squeeze(v)], pa.binary()) for v in (
                _steps(words[lo:hi]), sizes[lo:hi], _steps(names[met]), place.astype(np.uint32), own.astype(np.uint32), counts[a:z])),
            pa.array([squeeze(np.concatenate([docs, local.astype(np.int64)]))], pa.binary()), pa.array([squeeze(flags)], pa.binary()),
        ], schema=_SENT_SCHEMA)


def _gather(buckets: int, chunk_tokens: int, by_doc: bool):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A place that stays the same when the task is tried again.
        chunk, number = Chunk(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc, held, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
                chunk.add(doc, held, text)
                if chunk.total >= chunk_tokens:
                    yield from _send(chunk, number, buckets, by_doc)
                    chunk, number = Chunk(), number + 1
        if chunk.total:
            yield from _send(chunk, number, buckets, by_doc)

    return gather


def _entries(row: dict) -> tuple[np.ndarray, ...]:
    words, sizes, names, cells, rows, counts = (expand(row[n], kind) for n, kind in _ENTRIES)
    return (np.cumsum(words, dtype=np.uint64), sizes.astype(np.int64), np.cumsum(names, dtype=np.uint64), cells, rows,
            counts.astype(np.int64))


_MODEL = ("bucket int, words binary, sizes binary, names binary, cells binary, counts binary, types bigint, tokens bigint, "
          "word_rarity array<bigint>, pair_rarity array<bigint>")


def _rarity(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2 and so on, up to one more than is discounted."""
    return np.bincount(np.minimum(counts, MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)[1:-1].tolist()


def _combined(run: pa.Table) -> tuple[np.ndarray, ...]:
    """The entries of several rows of a bucket as one: words, contexts, and word, place of the context and count of each entry."""
    parts = [_entries(r) for r in run.select([n for n, _ in _ENTRIES]).to_pylist()]
    words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    names, place = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
    bits = np.uint64(len(names).bit_length())
    key = np.repeat(at.astype(np.uint64) << bits, np.concatenate([p[1] for p in parts]))
    ends = np.cumsum([0, *(len(p[2]) for p in parts)])
    key |= np.concatenate([place[e:][p[3]] for e, p in zip(ends, parts)]).astype(np.uint64)
    counts = np.concatenate([p[5] for p in parts])
    order = np.argsort(key, kind="stable")
    key, counts = key[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key, counts = key[first], np.add.reduceat(counts, first)
    return words, names, (key >> bits).astype(np.int64), (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.uint32), counts


_COMBINED = "bucket int, words binary, sizes binary, names binary, cells binary, rows binary, counts binary"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket and salt as one row, as it was sent."""
    for run in runs(batches, ("bucket", "salt")):
        words, names, word, cells, counts = _combined(run)
        columns = {
            "words": _steps(words), "sizes": np.bincount(word, minlength=len(words)).astype(np.uint32), "names": _steps(names),
            "cells": cells, "rows": np.zeros(0, np.uint32), "counts": counts.astype(np.uint32)}
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array([run.column("bucket")[0].as_py()], pa.int32())} | {n: [squeeze(c)] for n, c in columns.items()})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in runs(batches, ("bucket",)):
        words, names, word, cells, counts = _combined(run)
        totals = np.bincount(word, counts, len(words)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([run.column("bucket")[0].as_py()], pa.int32()),
            "words": [squeeze(_steps(words))],
            "sizes": [squeeze(np.bincount(word, minlength=len(words)).astype(np.uint32))],
            "names": [squeeze(_steps(names))],
            "cells": [squeeze(cells)],
            "counts": [squeeze(counts.astype(np.uint64))],
            "types": [len(words)], "tokens": [int(totals.sum())],
            "word_rarity": [_rarity(totals)], "pair_rarity": [_rarity(counts)]})


def discounts(rarity: list[int]) -> np.ndarray:
    """Factors for counts 0, 1, .. after Katz, for as many counts as Good-Turing estimates are usable.

    With too few counts for any estimate, half a count is taken off a count of one.
    """
    for most in range(MOST_DISCOUNTED, 0, -1):
        n = [0, *rarity[:most + 1]]
        if min(n[1:]) <= 0:
            continue
        beyond = (most + 1) * n[most + 1] / n[1]
        found = [((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond) if beyond < 1 else -1 for r in range(1, most + 1)]
        if all(0 < d < 1 for d in found):
            return np.asarray([0.0, *found])
    return np.asarray([0.0, 0.5])


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Counts less what Good-Turing takes off them. Without a count of one, the fallback factor hits nothing."""
    return counts * np.append(factors, 1.0)[np.minimum(counts, len(factors))]


@dataclass
class Numbers:
    """The bounded part of the model: totals and discounts."""

    tokens: int
    types: int
    word_factors: np.ndarray
    pair_factors: np.ndarray
    unknown: float  # P(word never seen)
    kept: float  # discounted counts of all words

    def word(self, counts: np.ndarray) -> np.ndarray:
        """P(word) by its count; what discounts take off goes to the unknown word (count 0)."""
        seen = discounted(counts, self.word_factors) * ((1 - self.unknown) / self.kept if self.kept else 0.0)
        return np.where(counts > 0, seen, self.unknown)

    def part(self, total: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """P(word | context) but for the weights of the context: the discounted count of a pair that was seen, else P(word)."""
        return np.where(pair > 0, discounted(pair, self.pair_factors), self.word(total))

    def base(self, total: np.ndarray) -> np.ndarray:
        return (total + ADDED) / (self.tokens + ADDED * (self.types + 1))


@dataclass
class Model(Numbers):
    """The numbers with the stored weights of contexts: ``cell``, log10 of ``scale`` and of backoff over scale, ``step``."""

    weights: DataFrame | None = None

    def numbers(self) -> Numbers:
        """Without the table, for tasks."""
        return Numbers(*(getattr(self, f.name) for f in fields(Numbers)))

    def token(self, total: np.ndarray, pair: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """P(word | context), with the weights of a few contexts read from the table; contexts never seen have the weight 1."""
        asked, at = np.unique(np.asarray(cells).astype(np.uint64), return_inverse=True)
        found = {r.cell: (r.scale, r.step) for r in self.weights.filter(F.col("cell").isin(asked.view(np.int64).tolist())).collect()}
        scale, step = np.asarray([found.get(c, (0.0, 0.0)) for c in asked.view(np.int64).tolist()]).reshape(-1, 2).T
        return self.part(total, pair) * 10 ** (scale[at] + np.where(pair > 0, 0.0, step[at]))


class Bucket:
    """The stored counts of one bucket of words."""

    def __init__(self, row: dict):
        self.words = np.cumsum(expand(row["words"], np.uint64), dtype=np.uint64)
        sizes = expand(row["sizes"], np.uint32).astype(np.int64)
        self.names = np.cumsum(expand(row["names"], np.uint64), dtype=np.uint64)
        self.places = expand(row["cells"], np.uint32)
        self.counts = expand(row["counts"], np.uint64).astype(np.int64)
        self.word = np.repeat(np.arange(len(self.words)), sizes)
        self.totals = np.bincount(self.word, self.counts, len(self.words)).astype(np.int64)
        self.bits = np.uint64(len(self.names).bit_length())
        self.key = self.word.astype(np.uint64) << self.bits | self.places

    @property
    def cells(self) -> np.ndarray:
        """The context of each entry."""
        return self.names[self.places]

    @classmethod
    def empty(cls) -> Bucket:
        kinds = {"words": np.uint64, "sizes": np.uint32, "names": np.uint64, "cells": np.uint32, "counts": np.uint64}
        return cls({n: squeeze(np.zeros(0, k)) for n, k in kinds.items()})

    def find(self, words: np.ndarray, sizes: np.ndarray, names: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For entries: the count of the word, and of the word in that context."""
        at, there = _places(self.words, words)
        total = np.zeros(len(words), np.int64)
        total[there] = self.totals[at[there]]
        place, known = _places(self.names, names)
        key = np.repeat(at, sizes).astype(np.uint64) << self.bits | place[cells].astype(np.uint64)
        at, hit = _places(self.key, key)
        hit &= np.repeat(there, sizes) & known[cells]
        pair = np.zeros(len(key), np.int64)
        pair[hit] = self.counts[at[hit]]
        return np.repeat(total, sizes), pair


def _places(among: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values stand in a sorted array, and whether they are there."""
    at = np.searchsorted(among, asked)
    there = at < len(among)
    there[there] = among[at[there]] == asked[there]
    return at, there


def _context_sums(numbers: Numbers):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Bucket(row)
                likely = numbers.word(b.totals)[b.word]
                n, kept, lower = (
                    np.bincount(b.places, w, len(b.names)) for w in (b.counts, discounted(b.counts, numbers.pair_factors), likely))
                yield pa.RecordBatch.from_pydict(
                    {"cell": b.names.view(np.int64), "n": n.astype(np.int64), "kept": kept, "lower": lower})

    return sums


def _weights(sums: DataFrame) -> DataFrame:
    """Backoff weights of contexts. Where no count in a context is discounted, half a count goes to the words not seen in it."""
    n = F.col("n")
    kept = F.when(F.col("kept") < n - 1e-9, F.col("kept")).otherwise(n - 0.5)
    scale, backoff = F.log10(kept / F.col("kept") / n), F.log10((1 - kept / n) / (1 - F.col("lower")))
    return sums.select("cell", scale.alias("scale"), (backoff - scale).alias("step"))


def _bucket(cell: str, buckets: int) -> Column:
    """The bucket a word falls into."""
    return F.shiftright(F.shiftrightunsigned(cell, 32) * F.lit(buckets).cast("bigint"), 32).cast("int")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scales of the words of a bucket as one row."""
    for run in runs(batches, ("bucket",)):
        cells = run.column("cell").to_numpy().view(np.uint64)
        order = np.argsort(cells)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([run.column("bucket")[0].as_py()], pa.int32()),
            "words": [squeeze(_steps(cells[order]))], "counts": [squeeze(run.column("scale").to_numpy()[order])]})


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("chunk"), F.lit(salts).cast("bigint")).cast("int").alias("salt")


def train(rows: DataFrame, buckets: int, chunk_tokens: int, salts: int = 1) -> tuple[DataFrame, Model]:
    """The stored table of counts, a row for each bucket of words, and the rest of the model with its stored weights.

    Entries of a bucket are first combined by ``salts`` groups of chunks, then all together; what is combined has an entry for each
    word and context.
    """
    sent = rows.mapInArrow(_gather(buckets, chunk_tokens, False), _SENT)
    if salts > 1:
        dealt = sent.withColumn("salt", _salt(salts)).repartition(2 * buckets * salts, "bucket", "salt")
        with batches_of(rows.sparkSession, BLOB_ROWS):
            sent = stored(dealt.sortWithinPartitions("bucket", "salt").mapInArrow(_combine, _COMBINED), "combined")
    with batches_of(rows.sparkSession, BLOB_ROWS):
        model = stored(sent.repartition(2 * buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_merge, _MODEL), "counts")
    each = [F.sum(F.element_at(c, r)).alias(f"{c}{r}") for c in ("word_rarity", "pair_rarity") for r in range(1, MOST_DISCOUNTED + 2)]
    found = model.agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens"), *each).first()
    tokens, types = found.tokens or 0, found.types or 0
    word_rarity, pair_rarity = (
        [found[f"{c}{r}"] or 0 for r in range(1, MOST_DISCOUNTED + 2)] for c in ("word_rarity", "pair_rarity"))
    factors = discounts(word_rarity)
    off = float(sum(n * r * (1 - factors[r]) for r, n in enumerate(word_rarity, 1) if r < len(factors)))
    # Half a count at least for unknown words, even where no word was seen once.
    unknown = min(0.5, max(off, 0.5) / tokens) if tokens else 1.0
    numbers = Numbers(tokens, types, factors, discounts(pair_rarity), unknown, tokens - off)
    with batches_of(rows.sparkSession, BLOB_ROWS):
        weights = stored(_weights(
            model.mapInArrow(_context_sums(numbers), "cell bigint, n bigint, kept double, lower double")
            .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"), F.sum("lower").alias("lower"))), "contexts")
    return model, Model(*vars(numbers).values(), weights)


_PART = ("chunk bigint, rows binary, docs binary, flags binary, n_tokens binary, n_known binary, base binary, score binary, "
         "lost_rows binary, lost_cells binary, lost_counts binary")
_SCORED = "chunk bigint, row bigint, doc_id bigint, flags int, n_tokens bigint, n_known bigint, base_score double, score double"
# Rows of a bucket that come before its requests.
_COUNTS, _SCALES = -1, -2


def _score(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bucket = shared.value, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if (row["bucket"], row["salt"]) != bucket:  # its scales and counts, if there are any, come first
                    bucket, counts, scaled, scales = (row["bucket"], row["salt"]), Bucket.empty(), np.zeros(0, np.uint64), np.zeros(0)
                if row["chunk"] == _SCALES:
                    scaled, scales = np.cumsum(expand(row["words"], np.uint64), dtype=np.uint64), expand(row["counts"], np.float64)
                    continue
                if row["chunk"] == _COUNTS:
                    counts = Bucket(row)
                    continue
                words, sizes, names, cells, rows, times = _entries(row)
                total, pair = counts.find(words, sizes, names, cells)
                # what follows a word is in its context
                at, there = _places(scaled, words)
                follow = np.zeros(len(words))
                follow[there] = scales[at[there]]
                flags = expand(row["flags"], np.uint8)
                docs, local = np.split(expand(row["docs"], np.int64), 2)
                lost = np.flatnonzero(pair == 0)

                def summed(weights: np.ndarray) -> np.ndarray:
                    return np.bincount(rows, weights * times, len(docs))

                columns = {
                    "rows": local, "docs": docs, "flags": flags, "n_tokens": summed(np.ones(len(times))),
                    "n_known": summed(total > 0), "base": summed(np.log10(numbers.base(total))),
                    "score": summed(np.log10(numbers.part(total, pair)) + np.repeat(follow, sizes)),
                    "lost_rows": local[rows[lost]], "lost_cells": names[cells[lost]], "lost_counts": times[lost]}
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([row["chunk"]], pa.int64())} | {n: [squeeze(c)] for n, c in columns.items()})

    return score


def _lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that were not seen: their text, context and number."""
    for batch in batches:
        for r in batch.to_pylist():
            row, cell, times = (expand(r[n], np.int64) for n in ("lost_rows", "lost_cells", "lost_counts"))
            yield pa.RecordBatch.from_pydict({"chunk": np.full(len(row), r["chunk"], np.int64), "row": row, "cell": cell, "times": times})


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk, each summed over the buckets that hold its words."""
    for run in runs(batches, ("chunk",)):
        parts = run.to_pylist()
        rows, at = np.unique(np.concatenate([expand(p["rows"], np.int64) for p in parts]), return_inverse=True)
        docs, flags = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int32)
        docs[at] = np.concatenate([expand(p["docs"], np.int64) for p in parts])
        flags[at] = np.concatenate([expand(p["flags"], np.uint8) for p in parts])
        n_tokens, n_known, base, score = (
            np.bincount(at, np.concatenate([expand(p[c], np.float64) for p in parts]), len(rows))
            for c in ("n_tokens", "n_known", "base", "score"))
        yield pa.RecordBatch.from_pydict({
            "chunk": np.full(len(rows), parts[0]["chunk"], np.int64), "row": rows,
            "doc_id": docs, "flags": flags, "n_tokens": n_tokens.astype(np.int64), "n_known": n_known.astype(np.int64),
            "base_score": base, "score": score})


def score_texts(
    docs: DataFrame, *, folds: int = 10, bucket_bytes: int = BUCKET_BYTES, chunk_tokens: int = CHUNK_TOKENS,
    chunks_together: int = CHUNKS_TOGETHER,
) -> DataFrame:
    """Scores of all whole texts: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from rows whose crc32(doc_id) mod ``folds`` is not 0. Tokens are white-space words with ASCII letters lowered,
    by a 64-bit hash, then one end. ``base_score`` sums additively smoothed unigram log10 probabilities; ``score`` sums
    log10 P(word | word before): a pair seen in training has its discounted share, others the backoff weight of their context
    times P(word), and words never seen share one probability. For every context the probabilities of all words and the
    unknown one sum to 1. A context is the word before, by its 64-bit hash. What asks for a bucket of words is dealt to tasks by ``chunks_together``
    chunks of documents, each with a copy of the bucket's counts, so a very frequent word is asked for in many tasks; so are pairs
    that were not seen, with copies of the weights of contexts.

    A null or empty text is its end alone. Rows without doc_id are held out; repeated rows count and are returned
    each. Other columns are not read. With nothing to learn from, all words are unknown. An empty table gives no rows.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first().n or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    salts = max(1, math.ceil(size / (_TOKEN_BYTES * chunk_tokens * chunks_together)))
    ids, held = F.col("doc_id").cast("bigint").alias("doc_id"), (fold("doc_id", folds) == 0).alias("held_out")
    model, numbers = train(text_rows(docs.filter(fold("doc_id", folds) != 0), ids, held), buckets, chunk_tokens, salts)
    weights, all_salts = numbers.weights, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    first = weights.filter(F.col("cell") == int(begin().view(np.int64))).first()
    with batches_of(spark, SCALE_ROWS):
        scales = stored(
            weights.select(_bucket("cell", buckets).alias("bucket"), "cell", "scale").repartition(2 * buckets, "bucket")
            .sortWithinPartitions("bucket").mapInArrow(_pack, "bucket int, words binary, counts binary"), "scales")
    asked = text_rows(docs, ids, held).mapInArrow(_gather(buckets, chunk_tokens, True), _SENT)

    def ahead(df: DataFrame, chunk: int) -> DataFrame:
        """Rows that come before the requests of a bucket, for each salt."""
        there = [F.col(c) if c in df.columns else F.lit(None).cast("binary").alias(c) for c in asked.columns[2:]]
        return df.select("bucket", F.lit(chunk).cast("bigint").alias("chunk"), *there, all_salts)

    dealt = ahead(model, _COUNTS).union(ahead(scales, _SCALES)).union(asked.withColumn("salt", _salt(salts)))
    dealt = dealt.repartition(2 * buckets * salts, "bucket", "salt").sortWithinPartitions("bucket", "salt", "chunk")
    with batches_of(spark, BLOB_ROWS):
        parts = stored(dealt.mapInArrow(_score(spark.sparkContext.broadcast(numbers.numbers())), _PART), "parts")
        sums = stored(
            parts.select(*[c for c in parts.columns if not c.startswith("lost")]).repartition("chunk")
            .sortWithinPartitions("chunk").mapInArrow(_add_up, _SCORED), "sums")
        lost = parts.select("chunk", "lost_rows", "lost_cells", "lost_counts").mapInArrow(
            _lost, "chunk bigint, row bigint, cell bigint, times bigint")
        steps = lost.withColumn("salt", _salt(salts)).join(weights.select("cell", "step", all_salts), ["cell", "salt"])
        scores = stored(sums.join(
            steps.groupBy("chunk", "row").agg(F.sum(F.col("times") * F.col("step")).alias("lost")), ["chunk", "row"], "left"), "scores")
    score = F.col("score") + F.lit(first.scale if first else 0.0) + F.coalesce("lost", F.lit(0.0))
    return scores.select(
        F.when(F.col("flags") < 2, F.col("doc_id")).alias("doc_id"), (F.col("flags") % 2 == 1).alias("held_out"),
        "n_tokens", "n_known", F.lit(numbers.tokens).cast("bigint").alias("train_tokens"), "base_score", score.alias("score"))
