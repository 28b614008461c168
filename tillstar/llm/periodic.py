"""Periodic runs of words, found with string synchronising sets at dyadic scales."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import mix64, spans_of, text_rows

# A run has at least so many words, and so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
# Highly periodic regions have three periods at least; they are kept out of the synchronising sets.
_REGION_PERIODS = 3
# Words of a batch that are searched together; a longer document is searched alone.
TOGETHER = 1 << 17
_NEVER = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _ODD + b)


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def synchronising_set(context: np.ndarray, scale: int, omitted: np.ndarray) -> np.ndarray:
    """Places i where the smallest hash of ``scale`` words among places i..i+scale is that of i or of i+scale.

    ``context`` has the hash of the ``scale`` words from each place; ``omitted`` marks places within highly
    periodic regions, whose hashes do not count. Whether a place is chosen depends on its next 2 x ``scale`` words
    only, and every ``scale`` neighbouring places hold a chosen one unless the 3 x ``scale`` - 1 words from the first of them
    have a period of ``scale`` / 3 at most.
    """
    order = np.where(omitted, _NEVER, context >> np.uint64(1))
    low = _sliding_minimum(order, scale + 1)
    return np.flatnonzero((low != _NEVER) & ((order[:len(low)] == low) | (order[scale:scale + len(low)] == low)))


def _same_ahead(words: np.ndarray, at: int, period: int) -> int:
    """The place where ``words`` stops to repeat what stands ``period`` places before, from ``at`` on."""
    step = 64
    while at < len(words):
        to = min(len(words), at + step)
        differ = words[at:to] != words[at - period:to - period]
        if differ.any():
            return at + int(differ.argmax())
        at, step = to, 2 * step
    return at


def _same_behind(words: np.ndarray, at: int, period: int) -> int:
    """The first place from which all words up to ``at`` repeat ``period`` places later."""
    step = 64
    while at > 0:
        low = max(0, at - step)
        differ = words[low:at] != words[low + period:at + period]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = low, 2 * step
    return at


def _prime_factors(n: int) -> Iterator[int]:
    f = 2
    while f * f <= n:
        if n % f == 0:
            yield f
            while n % f == 0:
                n //= f
        f += 1
    if n > 1:
        yield n


def _stretch(words: np.ndarray, first: int, last: int, context: int, period: int) -> tuple[int, int] | None:
    """The whole stretch with this as its smallest period around places whose contexts repeat; None if there is none."""
    end = last + period + context
    if not np.array_equal(words[first:end - period], words[first + period:end]):
        return None  # equal hashes of different words
    start, end = _same_behind(words, first, period), _same_ahead(words, end, period)
    if end - start < _REGION_PERIODS * period:
        return None
    for f in _prime_factors(period):
        if np.array_equal(words[start:end - period // f], words[start + period // f:end]):
            return None  # this smaller period is found for itself
    return start, end


def periodic_regions(words: np.ndarray, longest: int | None = None) -> dict[tuple[int, int], int]:
    """End by (start, period) of all maximal stretches of three periods or more that can matter for runs of ``longest`` words.

    Scales s are powers of two. A stretch of smallest period q with s/3 < q <= 8s/3 and at least q + 4s - 1 words
    has a chosen place i among its first s, and i + q is chosen too; the next equal context of 3s words (not
    shorter than q) after i is the one at i + q. So neighbours in a list of chosen places by context and place propose every such period. Every run of four periods
    is long enough at one scale. So is every region of a period up to s/3 that has to be left out of the set of scale
    s, at s/8 or a smaller one: regions are complete before the scale that needs them.
    """
    n = len(words)
    longest = n if longest is None else longest
    found: dict[tuple[int, int], int] = {}
    context, scale = mix64(words.astype(np.uint64) + _ODD), 1
    while scale == 1 or 16 * scale < 3 * longest:
        if 3 * scale > n:
            break
        edges = np.zeros(len(context) + 1, np.int64)
        for (start, period), end in found.items():
            if 3 * period <= scale <= end - start:
                edges[start] += 1
                edges[end - scale + 1] -= 1
        chosen = synchronising_set(context, scale, np.cumsum(edges[:-1]) > 0)
        chosen = chosen[chosen + 3 * scale <= n]
        key = _paired(_paired(context[chosen], context[chosen + scale]), context[chosen + 2 * scale])
        order = np.argsort(key, kind="stable")
        key, place = key[order], chosen[order]
        period = np.diff(place)
        proposed = (key[1:] == key[:-1]) & (3 * period <= 8 * scale)
        place, period = place[:-1][proposed], period[proposed]
        order = np.lexsort((place, period))
        place, period = place[order], period[order]
        # Proposals of one period that overlap by it belong to one stretch.
        new = np.ones(len(place), bool)
        new[1:] = (period[1:] != period[:-1]) | (np.diff(place) > 3 * scale)
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(place)) - 1
        for first, last, q in zip(place[firsts].tolist(), place[lasts[:len(firsts)]].tolist(), period[firsts].tolist()):
            stretch = _stretch(words, first, last, 3 * scale, q)
            if stretch:
                found[stretch[0], q] = stretch[1]
        if len(context) <= scale:
            break
        context = _paired(context[:-scale], context[scale:])
        scale *= 2
    return found


def periodic_tail(words: list[bytes], doc: int | None) -> list[bytes]:
    """Words of a document after one in ten (by the hash of its identifier) has its end replaced by a repetition."""
    if doc is None or not words:
        return words
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole, rest = divmod(n - a, p)
    root = words[a:a + p]
    return words[:a] + root * whole + root[:rest]


def _find(tails: bool, least_words: int, least_periods: int):
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("n_runs", pa.int64()),
        ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
        ("runs_sha256", pa.string()), ("n_kept", pa.int64()), ("collapsed_sha256", pa.string())])

    def row(doc, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        best = None
        drop = np.zeros(len(words), bool)
        for start, length, period in runs:
            drop[start + period:start + length] = True
            if best is None or length * best[2] > best[1] * period:
                best = start, length, period
        kept = [words[i] for i in np.flatnonzero(~drop).tolist()] if runs else words
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        return (
            doc, len(words), [{"start": s, "length": n, "period": q} for s, n, q in runs], len(runs),
            *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            docs = batch.column("doc_id").to_pylist()
            texts = [(t or b"").split() for t in batch.column("text").to_pylist()]
            if tails:
                texts = [periodic_tail(w, d) for w, d in zip(texts, docs)]
            runs: list[list[tuple[int, int, int]]] = [[] for _ in docs]
            number = defaultdict(count().__next__)
            # Documents of about one length are searched together, with a word of its own after each.
            alike = defaultdict(list)
            for i, words in enumerate(texts):
                if len(words) >= least_words:
                    alike[len(words).bit_length()].append(i)
            for own in alike.values():
                for low, high in spans_of([len(texts[i]) + 1 for i in own], TOGETHER):
                    joined, starts = [], []
                    for k, i in enumerate(own[low:high]):
                        starts.append(len(joined))
                        joined.extend(map(number.__getitem__, texts[i]))
                        joined.append(-1 - k)
                    longest = max(len(texts[i]) for i in own[low:high])
                    regions = periodic_regions(np.asarray(joined, np.int64), longest)
                    for (start, period), end in regions.items():
                        if end - start >= max(least_words, least_periods * period):
                            at = int(np.searchsorted(starts, start, "right")) - 1
                            runs[own[low + at]].append((start - starts[at], end - start, period))
            rows = [row(d, w, sorted(r, key=lambda x: (x[0], x[2]))) for d, w, r in zip(docs, texts, runs)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return find


def periodic_runs(
    docs: DataFrame, *, tails: bool = False, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """Maximal periodic runs of words in every whole text.

    A run is a stretch of ``least_words`` words and ``least_periods`` (four at least) times its smallest period that neither neighbour
    continues. Rows: ``doc_id, n_words, runs`` (start, length, period; by start, then period), ``n_runs``; of the run with the
    greatest length / period (ties: smallest start, then period) ``start, length, period, exponent_milli``, else null;
    ``runs_sha256`` of all runs as lines, ``n_kept`` and ``collapsed_sha256`` of the words that stay when each run is reduced to its first period.
    ``tails`` first gives one document in ten a periodic end (``periodic_tail``).

    A document is searched in one task, in memory of a few arrays of its words. Null and empty texts have no words; a null doc_id gets no
    periodic end. Repeated rows are searched each, other columns are not read. An empty table gives no rows.
    """
    if least_periods < LEAST_PERIODS:
        raise ValueError(f"runs of fewer than {LEAST_PERIODS} periods are not all proposed")
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    return text_rows(docs, ids).mapInArrow(
        _find(tails, least_words, least_periods),
        "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, n_runs bigint, "
        "start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, n_kept bigint, "
        "collapsed_sha256 string")
