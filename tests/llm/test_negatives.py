"""Hard negatives against all pairs, in integers."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tillstar.llm import negatives
from tillstar.llm.queries import op12_hard_negatives

SMALL = "/root/testdata/sf0.01"


def plain(rows, is_anchor, k=5, percent=80):
    """rows: (vec_id, label, vector), one for each vec_id."""
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, lab, v in ok:
        if not is_anchor(a):
            continue
        ranked = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in ok if i != a and len(w) == len(v))
        for score, p, _ in [r for r in ranked if r[2] == lab][:k]:
            good = [r for r in ranked if r[2] != lab and 80 * -score <= 100 * -r[0] <= 100 * -score] if percent == 80 else []
            out += [(a, p, n, i, -score, -s) for n, (s, i, _) in enumerate(good[:k], 1)]
    return sorted(out)


def test_query_agrees_with_all_pairs(spark):
    data = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 and r.label is not None else r.label, r.embedding) for r in data]
    got = op12_hard_negatives(spark, SMALL)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(rows, lambda i: i % 100 == 0)
    assert want and sorted(tuple(r) for r in got.collect()) == want


def test_reading_stops_early_and_keeps_ties():
    rng = np.random.default_rng(1)
    read = 0
    for trial in range(200):
        n, d = rng.integers(1, 400), rng.integers(1, 5)
        vectors = rng.integers(-4, 5, (n, d)).astype(float)
        anchor = rng.integers(-3, 4, d).astype(float)
        ids = rng.permutation(n)
        allowed = rng.random(n) < 0.8
        windows = [(None, None), (1, 3), (-5, 9), (None, 2)]
        got = negatives.threshold_search(vectors, negatives._sorted_lists(vectors), anchor, allowed, windows, ids, 5)
        scores = vectors @ anchor
        for (low, high), found in zip(windows, got):
            fit = [(-s, i) for s, i, a in zip(scores, ids, allowed) if a and (low is None or s >= low) and (high is None or s <= high)]
            assert [(-s, i) for s, i in found] == sorted(fit)[:5]

    class Counted(np.ndarray):
        def __matmul__(self, other):
            nonlocal read
            read += len(self) if self.ndim == 2 else 0
            return np.asarray(self) @ np.asarray(other)

    vectors = (rng.random((20000, 3)) * 256 // 1)
    negatives.threshold_search(vectors.view(Counted), negatives._sorted_lists(vectors), np.array([200.0, 30.0, 10.0]),
                               np.ones(20000, bool), [(None, None)], np.arange(20000), 5)
    assert 0 < read < 4000


def test_rows_of_all_kinds(spark):
    rng = random.Random(2)
    base = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(12)]
    rows = [(i, rng.randrange(3), [x + rng.uniform(-0.2, 0.2) for x in rng.choice(base)]) for i in range(300)]
    rows += [(300, 1, None), (301, None, base[0]), (302, 1, [None] + base[0][1:]), (303, 1, [float("nan")] + base[0][1:]),
             (304, 1, [float("inf")] + base[0][1:]), (305, 1, [0.0] * 6), (306, 1, []), (307, 2, []), (330, 1, []), (308, 0, [1.0, 2.0]),
             (None, 1, base[0]), (309, 2, [1e300] * 6), (310, 1, [-1e9] * 6), (311, 0, [3e8] * 6), (400, 0, [1e-300] * 6), (320, 77, base[3])]
    twice = rows + rows[:40]
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, lab, v in twice],
                               "vec_id bigint, embedding array<double>, label int, anchor string, positive_id int")
    usable = [r for r in rows if r[0] != 309]
    small = df.filter("vec_id <> 309")
    for block, anchor_block in ((None, 16384), (40, 7)):
        got = negatives.hard_negatives(small, F.col("vec_id") % 10 == 0, block=block, anchor_block=anchor_block)
        assert sorted(tuple(r) for r in got.collect()) == plain(usable, lambda i: i % 10 == 0)
    assert negatives.hard_negatives(df, F.col("vec_id") % 10 == 0).count() > 0  # scores beyond a long
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_one_label_for_all_has_no_negatives(spark):
    df = spark.range(50).select(F.col("id").alias("vec_id"), F.lit(1).alias("label"), F.array(F.lit(1.0), F.rand(1)).alias("embedding"))
    assert negatives.hard_negatives(df, F.col("vec_id") < 5).count() == 0
