"""Best-fit packing of tokenised documents by exact-complement hashing.

What fits where depends on piece lengths alone, of which there are ``capacity`` at most. So the
plan is made on the number of pieces of each length, in terms of patterns (lengths that share a
sequence) and how often each is used; pieces then take their places by their rank among
pieces of the same length, which Spark computes without gathering a length in one task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.common import stored, text_rows
from tillstar.operators.keys import with_keys

CAPACITY = 2048
END_ID = 0
# Distinct words whose ids a Python worker remembers; beyond it, memory is emptied before the next batch.
REMEMBERED_WORDS = 1_000_000

# A run of symbols after a letter or digit is a token group of its own, as is what stands before it.
# The apostrophe is left out: with a letter after it, it opens a group.
_TAIL = re.compile(rb"^(.*[0-9a-z])([!-&(-/:-@\[-`{-~]+)$", re.S)


class _Numbers(dict):
    """Numbers of words in the order in which they are first looked up; ``new`` has those not learned yet."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordIds:
    """Token ids of whole texts, put together from the ids of their words.

    The tokenizer never joins what white space parts, so each distinct word is encoded once.
    ASCII capitals are lowered first, as the tokenizer does itself, except in words that may hold the
    spelling of a special token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a token group
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0
        # Where the ids of each word begin, and how many it has.
        self.starts, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def _keep(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of words, one word after the other."""
        end = self.used + len(ids)
        if end > len(self.ids):
            self.ids = np.resize(self.ids, max(end, 2 * len(self.ids)))
        self.ids[self.used:end] = ids
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > len(self.starts):
            more = max(len(self.known), 2 * len(self.starts))
            self.starts, self.sizes = np.resize(self.starts, more), np.resize(self.sizes, more)
        self.starts[at] = self.used + np.cumsum(sizes) - sizes
        self.sizes[at] = sizes
        self.used = end

    def _gather(self, at: np.ndarray) -> np.ndarray:
        """The ids of words given by number, one after the other."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - sizes), sizes)]

    def _learn(self) -> None:
        """Encode the words that were looked up for the first time."""
        first = len(self.known) - len(self.known.new)
        split, whole = [], []
        for word in self.known.new:
            m = _TAIL.match(word)
            if m and b"<|" not in word:
                split.append((word, *m.groups()))
            else:
                whole.append(word)
        for _, head, tail in split:
            for part in (head, tail):
                if self.known[part] >= first:
                    whole.append(part)  # maybe once more than needed
        self.known.new = []
        whole = list(dict.fromkeys(whole))
        letters, rest = [], []
        for word in whole:
            text = word.decode("utf-8", "replace")
            (letters if text.isalpha() else rest).append((word, text))
        for at in range(0, len(letters), 1000):
            rest += self._learn_letters(letters[at:at + 1000])
        self._learn_each(rest)
        if split:
            parts = [part for _, head, tail in split for part in (head, tail)]
            at = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
            self._keep([word for word, _, _ in split], self._gather(at), self.sizes[at].reshape(-1, 2).sum(1))

    def _encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _learn_each(self, words: list[tuple[bytes, str]]) -> None:
        if words:
            ids = [coded.ids for coded in self._encode([text for _, text in words])]
            self._keep([word for word, _ in words], np.fromiter(chain.from_iterable(ids), np.uint32),
                       np.fromiter(map(len, ids), np.int64, len(ids)))

    def _learn_letters(self, words: list[tuple[bytes, str]]) -> list[tuple[bytes, str]]:
        """Words of letters only are one token group each, so many are encoded as one text; returns those left to be encoded one by one."""
        ids = np.asarray(self._encode([" ".join(text for _, text in words)])[0].ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return words
        self._keep([word for word, _ in words], ids, np.diff(ends, prepend=0))
        return []

    def texts(self, texts: list[bytes | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each closed by ``end_id``, and where each text ends."""
        if len(self.known) > REMEMBERED_WORDS:
            self.forget()
        words = []
        for text in texts:
            text = text or b""
            words.append(text.lower().split() if b"<|" not in text
                         else [w if b"<|" in w else w.lower() for w in text.split()])
        counts = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        if self.known.new:
            self._learn()
        text_ends = np.concatenate([[0], np.cumsum(self.sizes[at])])[np.cumsum(counts)]
        closed = np.insert(self._gather(at), text_ends, np.uint32(end_id))
        return closed, text_ends + np.arange(1, len(texts) + 1)


# One for each Python worker, which serves many tasks.
_CODERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _CODERS:
        _CODERS.clear()
        _CODERS[path] = WordIds(path)
    return _CODERS[path]


def _cut(tokenizer_path: str, capacity: int, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(tokenizer_path)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, ends = coder.texts(batch.column("text").to_pylist(), end_id)
            data = memoryview(ids.astype("<u4").tobytes())
            rows, begin = [], 0
            for doc, end in zip(batch.column("doc_id").to_pylist(), ends.tolist()):
                for piece, at in enumerate(range(begin, end, capacity)):
                    upto = min(at + capacity, end)
                    rows.append((doc, piece, at - begin, upto - at, zlib.crc32(data[4 * at:4 * upto])))
                begin = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return cut


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    return text_rows(docs, ids).mapInArrow(
        _cut(tokenizer_path, capacity, end_id),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def _times(parts: list[int], left: np.ndarray) -> int:
    """How often all of ``parts`` can be taken together."""
    return min(int(left[p]) // parts.count(p) for p in set(parts))


def _complement(gap: int, left: np.ndarray) -> list[int] | None:
    """A single, pair or triple of available lengths that sums to ``gap`` exactly; long ones first."""
    if left[gap]:
        return [gap]
    there = left[:gap] > 0
    lengths = np.flatnonzero(there)[::-1]

    def pair(total: int, below: int) -> list[int] | None:
        # The hash index of single lengths is the array itself.
        first = lengths[(lengths >= (total + 1) // 2) & (lengths < min(total, below + 1))]
        first = first[there[first] & there[total - first]]
        for a in first.tolist():
            if 2 * a != total or left[a] > 1:
                return [a, total - a]
        return None

    found = pair(gap, gap)
    if found:
        return found
    # Pair sums of what is there, as an index of reachable sums, before any triple is tried.
    sums = np.zeros(gap + 1, bool)
    for b in lengths.tolist():
        reach = lengths[lengths <= min(b, gap - b)]
        sums[b + reach] = True
    for a in lengths[lengths < gap].tolist():
        if sums[gap - a]:
            left[a] -= 1  # a pair may not take this one again
            there[a] = left[a] > 0
            two = pair(gap - a, a)
            left[a] += 1
            there[a] = True
            if two:
                return [a, *two]
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with how many sequences use each, for so many pieces of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: dict[tuple[int, ...], int] = {}
    residual: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1  # the piece whose gap is to be filled
            parts = _complement(capacity - length, left) if length < capacity else []
            left[length] += 1
            if parts is None:
                residual[length] = int(left[length])
                left[length] = 0
                break
            whole = [length, *parts]
            times = _times(whole, left)
            for p in whole:
                left[p] -= times
            patterns[tuple(whole)] = patterns.get(tuple(whole), 0) + times
    # Best fit: each remaining length, longest first, into the smallest gap that takes it.
    for pattern, n in _best_fit(residual, capacity).items():
        patterns[pattern] = patterns.get(pattern, 0) + n
    return sorted(patterns.items(), reverse=True)


def _best_fit(residual: dict[int, int], capacity: int) -> dict[tuple[int, ...], int]:
    by_gap: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    for length in sorted(residual, reverse=True):
        n = residual[length]
        for gap in range(length, capacity):
            while n and by_gap[gap]:
                pattern, there = by_gap[gap].popitem()
                used = min(n, there)
                if used < there:
                    by_gap[gap][pattern] = there - used
                longer = (*pattern, length)
                by_gap[gap - length][longer] = by_gap[gap - length].get(longer, 0) + used
                n -= used
        # What is left opens sequences, which take as many of this length as fit.
        fit = capacity // length
        for many in (fit, n % fit):
            used = n // many if many else 0
            if used:
                new = (length,) * many
                by_gap[capacity - many * length][new] = by_gap[capacity - many * length].get(new, 0) + used
                n -= used * many
    out: dict[tuple[int, ...], int] = {}
    for patterns in by_gap:
        for pattern, n in patterns.items():
            out[pattern] = out.get(pattern, 0) + n
    return out


def _places(spark: SparkSession, counts: dict[int, int], capacity: int) -> DataFrame:
    """For ranks ``low`` to ``high`` (exclusive) of a length: sequence of the first, and offset in it."""
    taken = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    for pattern, n in plan(counts, capacity):
        offset, at = 0, 0
        while at < len(pattern):
            length = pattern[at]
            rows.append((length, taken[length], taken[length] + n, sequence, offset))
            taken[length] += n
            offset += length
            at += 1
        sequence += n
    return spark.createDataFrame(rows, "length bigint, low bigint, high bigint, base bigint, offset bigint")


def pack(
    docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its token ids and a closing ``end_id``; a null or empty text is the closing id
    alone. Only documents longer than ``capacity`` are cut, into full pieces and a rest. Repeated
    rows, and rows without doc_id, are packed each. Other columns are not read. An empty table gives no rows.

    The driver holds the number of pieces of each length (``capacity`` rows at most) and the plan, whose patterns are bounded
    by the lengths alone; the table of places is broadcast for that reason. For each length its longest exact complement
    of one, two or three lengths is taken as often as all of its parts last; what has none goes by best fit.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, total = [], 0
    for length in sorted(counts):
        first.append((length, total))
        total += counts[length]
    places = _places(spark, counts, capacity).join(
        F.broadcast(spark.createDataFrame(first, "length bigint, before bigint")), "length")
    ranked = with_keys(cut, "_rank", ["length", "doc_id", "piece"], start=0)
    return (
        ranked.join(F.broadcast(places), "length")
        .filter("_rank - before >= low and _rank - before < high")
        .select("doc_id", "piece", "start", "length", "ids_crc32",
                F.expr("base + (_rank - before - low)").alias("sequence_id"), "offset"))
