"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstar.llm import periodic
from tillstar.llm.queries import op13_periodic_runs

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, least_periods=4, least_words=6):
    """All maximal stretches by smallest period, period by period."""
    out, n = {}, len(words)
    for q in range(1, n // least_periods + 1):
        at = 0
        while at < n - q:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            stretch = (at, end + q)
            if end + q - at >= max(least_words, least_periods * q) and stretch not in out:
                out[stretch] = q  # periods ascend, so the first is the smallest
            at = end + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def found(words, least_periods=4, least_words=6):
    regions = periodic.periodic_regions(np.asarray(words, np.int64))
    return sorted((s, e - s, q) for (s, q), e in regions.items() if e - s >= max(least_words, least_periods * q))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_all_runs_of_repetitive_sequences(parts):
    words = [w for root, times in parts for w in root * times]
    assert found(words) == plain_runs(words)


def test_all_runs_of_many_shapes():
    rng = random.Random(3)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    shapes = [fib[-1], [0] * 999, [0, 1] * 400 + [0], ([0] * 30 + [1]) * 20, (([0, 0, 1] * 12 + [2]) * 5 + [3]) * 6,
              [bin(i).count("1") % 2 for i in range(1024)]]
    for _ in range(60):
        out = []
        while len(out) < rng.randint(20, 900):
            root = [rng.randint(0, 3) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 40, 100]))]
            out += (root * rng.randint(1, 9))[:rng.randint(1, 400)]
        shapes.append(out)
    for words in shapes:
        assert found(words) == plain_runs(words)


def test_all_regions_of_three_periods_where_the_scales_need_them():
    rng = random.Random(4)
    for _ in range(200):
        q = rng.randint(1, 40)
        root = [rng.randint(0, 1) for _ in range(q)]
        words = [9, 8] + root * rng.randint(3, 9) + [7] + [rng.randint(0, 1) for _ in range(40)] + [0] * rng.randint(0, 60)
        regions = periodic.periodic_regions(np.asarray(words, np.int64), 3 * len(words))
        scale = 1
        while 16 * scale < 3 * len(words):
            for s, length, p in plain_runs(words, 3, 1):
                if 3 * p <= scale <= length:
                    assert regions.get((s, p)) == s + length
            scale *= 2


def expected(doc, text, tails=True):
    words = (text or "").encode().split()
    if tails and doc is not None and words:
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    runs.sort(key=lambda r: (r[0], r[2]))
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_agrees_with_every_period(spark):
    got = op13_periodic_runs(spark, SMALL)
    assert got.columns == ["doc_id", *COLUMNS]
    docs = [d for d in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
            if len((d.text or "").split()) < 3000]
    have = {r.doc_id: tuple(r)[1:] for r in got.collect()}
    assert len(have) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert len(docs) > 150
    assert sum(have[d.doc_id][0] > 0 for d in docs) > 5
    for d in docs:
        assert have[d.doc_id] == expected(d.doc_id, d.text), d.doc_id


def test_rows_of_all_kinds(spark):
    texts = ["", None, "  \n", "one", "a a a a a", "a a a a a a", "a b " * 4, "  " * 8, "x y z " * 50000, "tie a a a a a a b b b b b b"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(5, texts[5], "s"), (None, "b " * 7, "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    got = periodic.periodic_runs(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in enumerate(texts):
        if i != 8:
            assert tuple(by[i][c] for c in COLUMNS) == expected(i, t, tails=False), i
    assert [tuple(r) for r in by[8].runs] == [(0, 150000, 3)] and by[8].n_kept == 3
    assert (by[9].start, by[9].n_runs) == (1, 2) and by[None].n_runs == 1 and sum(r.doc_id == 5 for r in got) == 2
    assert by[1].n_runs == 0 and by[1].start is None and by[1].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert periodic.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(df, least_periods=3)
