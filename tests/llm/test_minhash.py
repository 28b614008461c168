"""Near-duplicate documents against all pairs compared by hand."""

import itertools
import random

import numpy as np

from tillstar.llm import minhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, band string"


def brute(rows, width=4, percent=80):
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, None, None, None, "x") for d, t in rows], SCHEMA)
    return minhash.near_duplicates(df, **options).collect()


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):  # similarities on either side of the limit
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((doc * 7 % 101, rng.choice([" ", "\n", "  "]).join(text)))
            doc += 1
    return rows


def test_components_agree_with_all_pairs(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, rows)}
        assert got == brute(rows)


def test_chain_of_edits_is_one_component(spark):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for step in range(30):  # each document differs from the one before by one word only
        if step:
            base[step * 3] = f"new{step}"
        rows.append((100 - step, " ".join(base)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, rows)}
    assert got == brute(rows)
    assert {c for _, c, _ in got.values()} == {71}


def test_null_empty_short_and_repeated_rows(spark):
    long_text = " ".join(f"t{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Two words"), (5, "two\nWORDS"), (6, "two words more"),
            (7, long_text), (8, long_text + " end"), (9, "same"), (9, "same"), (None, "two words"), (11, "É a b c d"), (12, "é a b c d")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in run(spark, rows)), key=repr)
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
        (7, 29997, 7, True), (8, 29998, 7, False), (9, 1, 9, True), (9, 1, 9, True), (None, 1, None, True),
        (11, 2, 11, True), (12, 2, 12, True)], key=repr)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_intersections_agree_with_sets():
    rng = np.random.default_rng(8)
    for count, values, most in ((1, 5, 4), (60, 40, 30), (90, 400, 60)):
        sets = [np.sort(rng.choice(values, rng.integers(0, min(most, values)), replace=False)) for _ in range(count)]
        if not sum(map(len, sets)):
            continue
        got = minhash.intersections(sets)
        for i in range(count):
            for j in range(count):
                if i != j:
                    assert got[i, j] == len(set(sets[i]) & set(sets[j]))


def test_large_group_with_loose_members(spark, monkeypatch):
    monkeypatch.setattr(minhash, "GROUP_DOCS", 16)  # groups are cut into several blocks
    rng = random.Random(6)
    base, rows = [f"w{i}" for i in range(100)], []
    for doc in range(120):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(100)] = f"new{rng.randrange(10**6)}"
        rows.append((doc, " ".join(text)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, rows)}
    assert got == brute(rows)


def test_a_member_known_by_its_size_alone_still_meets_loose_ones(spark):
    """Of each group 0-1-2 are linked, 2 is too large to be compared with 0, and 3 is linked with 2 alone."""
    last = [*range(19, 100), *range(107, 136), *range(200, 210)]
    sets = [range(100), range(120), range(10, 136), last]
    rows = [(10 * g + i, " ".join(f"g{g}w{x}" for x in s)) for g in range(400) for i, s in enumerate(sets)]
    assert {d: c for d, (_, c, _) in brute(rows[:4], width=1).items()} == {0: 0, 1: 0, 2: 0, 3: 0}
    signed = minhash.signatures([minhash.shingle_set(t.encode(), 1) for _, t in rows], 2).reshape(400, 4, 2)
    # All share the first bucket; in the second, 1 and 2 are without the others.
    a, b = signed[:, :, 0], signed[:, :, 1]
    told = (a == a[:, :1]).all(1) & (b[:, 1] == b[:, 2]) & (b[:, 0] != b[:, 1]) & (b[:, 3] != b[:, 1]) & (b[:, 3] != b[:, 0])
    assert told.any()
    got = {r.doc_id: r.component_id for r in run(spark, rows, shingle_words=1, bands=2, band_rows=1)}
    assert all(got[int(10 * g + i)] == 10 * g for g in np.flatnonzero(told) for i in range(4))


def test_many_rows_of_one_document_are_compared_once(spark, monkeypatch):
    seen = {}

    def counted(df, label, keep=minhash.stored):
        seen[label] = keep(df, label)
        return seen[label]

    monkeypatch.setattr(minhash, "stored", counted)
    base = [f"w{i}" for i in range(60)]
    near = base[:-1] + ["other"]
    rows = [(1, " ".join(base))] * 40 + [(2, " ".join(near))] * 40 + [(3, "quite another text of some words")] + [(3, " ".join(near) + " end")]
    got = run(spark, rows)
    assert seen["verified"].count() == len({(r.a, r.b) for r in seen["verified"].collect()}) <= 3
    assert seen["sets"].count() == seen["sets"].select("id").distinct().count()
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got if r.doc_id < 3} == {(1, 1), (2, 1)}
