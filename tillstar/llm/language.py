"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import fold, spans_of, text_rows, with_small_batches

NONE = "und"
ORDERS = (1, 2, 3)
CELLS = 1 << 15
SMOOTHING = 0.5
# The matrix of log probabilities is broadcast: 32,768 cells for each language, and no more languages than this.
MOST_LANGUAGES = 1000
# Characters of several texts that are worked on at a time.
_CHARACTERS = 1 << 20


def _code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as code points with non-letters as blanks, each text between blanks, and where each begins."""
    lowered = ["\n" + t.lower() + "\n" if t else "\n\n" for t in texts]
    starts = np.cumsum([0, *map(len, lowered)])
    return np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32), starts


def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Grams:
    """Cells of the character n-grams of texts."""

    def __init__(self, cells: int):
        self.cells, self.letters = cells, _is_letter()

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
        """Which rows have letters; and for each order, the cells of n-grams that hold a letter, and their rows."""
        points, starts = _code_points(texts)
        letter = self.letters[points]
        points = np.where(letter, points, np.uint32(32))
        row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(starts))
        return np.bincount(row, letter, len(texts)) > 0, (self._order(n, points, letter, row) for n in ORDERS)

    def _order(self, n: int, points: np.ndarray, letter: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        state = np.full(max(0, len(points) - n + 1), n, np.uint32)
        there = np.zeros(len(state), bool)
        for j in range(n):
            state ^= points[j:j + len(state)]
            state *= np.uint32(0x9E3779B1)
            state ^= state >> np.uint32(15)
            there |= letter[j:j + len(state)]
        there &= row[:len(state)] == row[n - 1:]
        state *= np.uint32(0x85EBCA6B)
        return (state[there] >> np.uint32(8)) % np.uint32(self.cells), row[:len(state)][there]


def _texts(batch: pa.RecordBatch) -> list[str | None]:
    return [None if t is None else t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]


def _count(cells: int):
    schema = pa.schema([("lang", pa.string()), ("cell", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = Grams(cells), {}
        for batch in batches:
            langs = np.asarray(batch.column("lang").to_pylist(), object)
            texts = _texts(batch)
            for begin, end in spans_of([len(t) for t in texts], _CHARACTERS):
                for found, rows in grams.of(texts[begin:end])[1]:
                    for lang in set(langs[begin:end]):
                        own = (langs[begin:end] == lang)[rows]
                        sums[lang] = sums.get(lang, 0) + np.bincount(found[own], minlength=cells)
        for lang, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())],
                schema=schema)

    return count


def train(docs: DataFrame, cells: int = CELLS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log P(cell | language) + log prior shared out as a last column.

    All given rows with a text and a language count. The counts are summed in Spark; the driver
    gets one number for each language and cell.
    """
    labelled = docs.filter("lang is not null and text is not null")
    priors = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .limit(MOST_LANGUAGES + 1).collect()}
    if len(priors) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs = sorted(priors)
    counts = np.zeros((len(langs), cells))
    summed = text_rows(labelled, "lang").mapInArrow(_count(cells), "lang string, cell int, n bigint")
    for r in summed.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[langs.index(r.lang), r.cell] = r.n
    likelihood = np.log(counts + SMOOTHING) - np.log(counts.sum(1, keepdims=True) + SMOOTHING * cells)
    prior = np.log(np.asarray([priors[x] for x in langs], float) / max(1, sum(priors.values())))
    return langs, np.hstack([likelihood, prior.reshape(-1, 1)])


def _score(langs: list[str], shared, cells: int, text_field: bool):
    """Adds a prediction to the carried columns; the text is a column, or a field of the column ``row``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        table, prior = weights[:, :-1], weights[:, -1]
        grams = Grams(cells)
        for batch in batches:
            texts = batch.column("row").field("text").to_pylist() if text_field else _texts(batch)
            logs, has = np.zeros((len(texts), max(1, len(langs)))), np.zeros(len(texts), bool)
            for begin, end in spans_of([len(t or "") for t in texts], _CHARACTERS):
                has[begin:end], orders = grams.of(texts[begin:end])
                for found, rows in orders:
                    for k in range(len(langs)):
                        logs[begin:end, k] += np.bincount(rows, table[k][found], end - begin)
            if langs:
                logs += prior
                best = logs.argmax(1)
                share = np.where(has, 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1), 0.0)
                names = [langs[b] if h else NONE for b, h in zip(best, has)]
            else:
                names, share = [NONE] * len(texts), np.zeros(len(texts))
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(names, pa.string()), pa.array(share, pa.float64())],
                names=[*kept, "lang_pred", "score"])

    return score


def identify(docs: DataFrame, *, folds: int = 5, cells: int = CELLS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    Learns from rows whose crc32(doc_id) mod ``folds`` is not 0, and predicts all. ``score`` is the posterior of the
    language; ties go to the first by name. A null text, one without letters, and every text
    when nothing could be learned: ``und`` with score 0. More than ``MOST_LANGUAGES`` values of lang raise an error, as the table of weights is
    broadcast. A null doc_id counts as held out. Repeated rows count and are returned each; other columns are not read. An empty table gives no rows.
    """
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    held = (fold("doc_id", folds) == 0).alias("held_out")
    langs, weights = train(docs.filter(fold("doc_id", folds) != 0), cells)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    return text_rows(docs, ids, held).mapInArrow(
        _score(langs, shared, cells, False), "doc_id bigint, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame, *, folds: int = 5, cells: int = CELLS, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is told with a posterior of ``least_score`` at least, all columns as they are.

    Texts that are null or without letters are told no language and go; learning is as in ``identify``.
    """
    langs, weights = train(docs.filter(fold("doc_id", folds) != 0), cells)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    rows = with_small_batches(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    told = rows.mapInArrow(_score(langs, shared, cells, True), schema)
    return told.filter((F.col("lang_pred") != NONE) & (F.col("score") >= least_score)).select("row.*")
