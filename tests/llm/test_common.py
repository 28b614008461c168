"""Connected components and small helpers."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tillstar.llm import common


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(100)],
        "star": [(50, i) for i in range(100) if i != 50],
        "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(90)],
        "none": [],
    }[kind]
    got = common.components(spark.createDataFrame([*edges, (5, 5), (None, 7)], "a bigint, b bigint")).collect()
    want = plain([e for e in edges if e[0] != e[1]])
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_runs_are_whole_over_batches():
    keys = [1] * 3 + [2] + [3] * 7 + [4]
    table = pa.table({"k": keys, "v": list(range(12))})
    for size in (1, 2, 5, 100):
        found = [(r.column("k")[0].as_py(), r.column("v").to_pylist()) for r in common.runs(table.to_batches(size), ("k",))]
        assert found == [(1, [0, 1, 2]), (2, [3]), (3, list(range(4, 11))), (4, [11])]


def test_spans_and_smallest_reachable():
    assert list(common.spans_of([3, 3, 9, 1, 1], 6)) == [(0, 2), (2, 3), (3, 5)]
    assert list(common.spans_of([], 6)) == []
    root = common.smallest_reachable(np.asarray([3, 4, 1]), np.asarray([4, 0, 2]), 6)
    assert root.tolist() == [0, 1, 1, 0, 0, 5]
