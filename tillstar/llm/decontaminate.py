"""Benchmark decontamination by pigeonhole edit matching.

A test item of n letters may differ from a passage by k edits. Cut into k + 1 pieces, one piece at least
stands in the passage unchanged. An Aho-Corasick automaton finds all exact piece hits in one pass over
a document, and Myers' bit-parallel edit distance verifies each candidate in a window around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import text_rows, with_small_batches

# One edit for so many letters of an item.
LETTERS_PER_EDIT = 12
# Items with fewer letters are searched for without edits and as whole words.
LEAST_LETTERS = 20
# Letters of test items that are broadcast at a time; a larger benchmark takes several passes.
BLOCK_LETTERS = 8 << 20

# Letters around a piece hit that are compared before the whole item is.
_NEAR = 64

_LETTERS = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def normal(text: bytes | None) -> str:
    """Lower-cased words parted by single blanks; one character for each UTF-8 byte."""
    lowered = (text or b"").decode("utf-8", "replace").lower().encode()
    return b" ".join(lowered.translate(_LETTERS).split()).decode("latin-1")


def distance(pattern: str, text: str) -> tuple[int, int]:
    """The fewest edits between ``pattern`` and any part of ``text``, and where the first such part ends."""
    size = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, top = (1 << size) - 1, 1 << size - 1
    up, down, score, best, end = mask, 0, size, size, 0
    for at, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        cross = eq | down
        eq |= ((eq & up) + up) ^ up
        more, less = down | ~(eq | up) & mask, up & eq
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more, less = (more << 1) & mask, (less << 1) & mask
        up, down = less | ~(cross | more) & mask, more & cross
        if score < best:
            best, end = score, at
    return best, end


class Index:
    """Pieces of test items, and the items with their allowed edits."""

    def __init__(self, items: list[tuple[int, str]], letters_per_edit: int, least_letters: int):
        self.items = [(i, t, len(t) // letters_per_edit if len(t) >= least_letters else 0) for i, t in items if t]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, edits) in enumerate(self.items):
            if len(text) < least_letters:
                pieces.setdefault(f" {text} ", []).append((number, -1))
                continue
            cuts = [len(text) * j // (edits + 1) for j in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((number, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, int, int]]:
        """Item number, edits, begin and end of the best passage of each item found in a text."""
        starts: dict[int, dict[int, int]] = {}
        if self.items:
            # A blank on either side, so that short items are found as whole words.
            for end, (size, places) in self.automaton.iter(f" {text} "):
                for number, offset in places:
                    starts.setdefault(number, {})[end - size - offset] = offset
        found = []
        for number, places in starts.items():
            _, item, edits = self.items[number]
            best = (edits + 1, 0, 0)
            seen = None
            for at in sorted(places):
                if text.startswith(item, at) and at >= 0:
                    best = (0, at, at + len(item))
                    break
            else:
                for at in sorted(places):
                    if seen is not None and at <= seen:
                        continue  # its window was searched with the one before
                    # The letters around the piece cannot differ by more edits than the whole item may.
                    low = max(0, places[at] - _NEAR // 2)
                    part = item[low:low + _NEAR]
                    if distance(part, text[max(0, at + low - edits):max(0, at + low + len(part) + edits)])[0] > edits:
                        continue
                    # Windows of neighbouring starts overlap, so one search covers the next few starts too.
                    seen = at + edits
                    begin = max(0, at - edits)
                    window = text[begin:at + len(item) + 3 * edits]
                    fewest, end = distance(item, window)
                    if fewest < best[0]:
                        back = distance(item[::-1], window[:end][::-1])[1]
                        best = (fewest, begin + end - back, begin + end)
            if best[0] <= edits:
                found.append((number, *best))
        return sorted(found)


def blocks(benchmark: DataFrame, block_letters: int) -> Iterator[list[tuple[int, str]]]:
    """The items of a benchmark, so many letters at a time."""
    block: list[tuple[int, str]] = []
    total = 0
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("binary").alias("text"))
    for r in items.filter("item_id is not null and text is not null").distinct().toLocalIterator():
        text = normal(bytes(r.text))
        if block and total + len(text) > block_letters:
            yield sorted(block)
            block, total = [], 0
        block.append((r.item_id, text))
        total += len(text)
    if block:
        yield sorted(block)


_FOUND = "doc_id bigint, item_id bigint, edits int, letters int, first_word bigint, last_word bigint"


def _search(shared, letters_per_edit: int, least_letters: int):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("letters", pa.int32()),
                        ("first_word", pa.int64()), ("last_word", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, letters_per_edit, least_letters)
        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = normal(raw)
                for number, edits, begin, end in index.hits(text):
                    item_id, item, _ = index.items[number]
                    rows.append((doc, item_id, edits, len(item), text.count(" ", 0, begin + 1), text.count(" ", 0, max(begin + 1, end - 1))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([],) * 6, schema.types)], schema=schema)

    return search


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, letters_per_edit: int = LETTERS_PER_EDIT,
    least_letters: int = LEAST_LETTERS, block_letters: int = BLOCK_LETTERS,
) -> DataFrame:
    """One row per document and test item it holds: ``doc_id, item_id, edits, letters, first_word, last_word``.

    Texts and items are compared as lower-cased words (runs of ASCII letters and digits and of anything beyond
    ASCII). An item of n letters is found where a passage differs from it by n / ``letters_per_edit`` edits at
    most; of several passages, one with the fewest edits is given. An item of fewer than ``least_letters`` letters is found where its words
    stand unchanged.

    Null and empty texts hold nothing. Items that are null, have no id or no letters are not searched. Repeated rows are reported each; other columns are not read. Empty tables give no rows.
    The benchmark is broadcast in blocks of bounded size, each searched in one pass over the documents.
    """
    spark = docs.sparkSession
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    rows = text_rows(docs, ids)
    found = spark.createDataFrame([], _FOUND)
    for n, block in enumerate(blocks(benchmark, block_letters)):
        part = rows.mapInArrow(_search(spark.sparkContext.broadcast(block), letters_per_edit, least_letters), _FOUND)
        found = found.union(part) if n else part
    return found


def _keep(shared, letters_per_edit: int, least_letters: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, letters_per_edit, least_letters)
        for batch in batches:
            texts = batch.column("row").field("text").cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([not index.hits(normal(t)) for t in texts], pa.bool_()))

    return keep


def clean(
    docs: DataFrame, benchmark: DataFrame, *, letters_per_edit: int = LETTERS_PER_EDIT,
    least_letters: int = LEAST_LETTERS, block_letters: int = BLOCK_LETTERS,
) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns and without a shuffle."""
    spark = docs.sparkSession
    for block in blocks(benchmark, block_letters):
        carried = with_small_batches(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
        schema = T.StructType([T.StructField("row", docs.schema)])
        docs = carried.mapInArrow(
            _keep(spark.sparkContext.broadcast(block), letters_per_edit, least_letters), schema).select("row.*")
    return docs
