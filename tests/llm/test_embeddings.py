"""Near-duplicate embeddings against all pairs compared by hand."""

import math

import numpy as np

from tillstar.llm import embeddings
from tillstar.llm.queries import op2_embedding_near_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int, bucket string"


def brute(rows, threshold=0.93):
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {i: np.asarray(rows[i][1], np.float32).astype(float) for i in good}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    near = {i: [] for i in range(len(rows))}
    for i in good:
        for j in good:
            if i != j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                near[i].append(j)
    component = {}
    for i in sorted(range(len(rows)), key=lambda i: rows[i][0]):
        stack = [i]
        while stack:
            k = stack.pop()
            if k not in component:
                component[k] = rows[i][0]
                stack += near[k]
    return sorted((rows[i][0], len(near[i]), component[i], rows[i][0] == component[i]) for i in range(len(rows)))


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df, **options).collect())


def made(seed, n, groups, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, 16))
    rows = []
    for i in range(n):
        v = centres[rng.integers(groups)] + spread * rng.standard_normal(16)
        rows.append((1000 - i, (v * rng.uniform(0.1, 9)).astype(np.float32).tolist(), int(rng.integers(3))))
    return rows


def test_agrees_with_all_pairs_on_the_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept)
                 for r in op2_embedding_near_dedup(spark, "/root/testdata/sf0.01").collect())
    assert got == brute(rows)


def test_blocks_of_a_large_group_count_every_pair_once(spark):
    rows = made(4, 160, 3, 0.25)
    assert run(spark, rows, block=16) == brute(rows)


def test_copies_nulls_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 1) for i in range(60)] + [
        (100, [2.0, 0.1], 1), (101, [1.0, 0.0], 2), (102, None, 1), (103, [], 1), (104, [0.0, 0.0], 1), (105, [1.0, None], 1),
        (106, [1.0, nan], 1), (107, [inf, 0.0], 1), (108, [1.0, 0.0], None), (109, [1.0, 0.0, 0.0], 1), (110, [1.0, -0.0], 1),
        (111, [1e-30, 0.0], 1), (112, [3e38, 3e36], 1), (113, [-1.0, 0.0], 1)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_missing_ids(spark):
    assert run(spark, []) == []
    got = run(spark, [(None, [1.0, 0.0], 1)])
    assert got == [(None, 0, None, True)]


def test_bits_follow_the_number_of_vectors():
    assert embeddings.tables_for(10, 0.93, 1e-4, 32)[0] == 4
    bits, tables = embeddings.tables_for(10**9, 0.93, 1e-4, 32)
    assert 10**9 / 2**bits <= 32 and (1 - (1 - math.acos(0.93) / math.pi) ** bits) ** tables <= 1e-4
