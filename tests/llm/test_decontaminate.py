"""Leaked test items against an edit distance computed cell by cell."""

import random

from tillstar.llm import decontaminate
from tillstar.llm.queries import op1_benchmark_decontamination

SMALL = "/root/testdata/sf0.01"


def table_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (p != t)))
    best = min(row)
    return best, row.index(best)


def test_bit_parallel_distance():
    rng = random.Random(2)
    for _ in range(400):
        pattern = "".join(rng.choices("abc ", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc ", k=rng.randint(0, 120)))
        if rng.random() < 0.5:
            cut = list(pattern)
            for _ in range(rng.randint(0, 6)):
                cut[rng.randrange(len(cut))] = rng.choice(["", "a", "bb"])
            text = text[:40] + "".join(cut) + text[40:]
        assert decontaminate.distance(pattern, text) == table_distance(pattern, text)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, item_id string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.leaks(d, b, **options).collect()
    kept = decontaminate.clean(d, b, **options)
    assert kept.columns == d.columns
    flagged = {r.doc_id for r in found}
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(str(d) for d in docs if d[0] not in flagged)
    return found


def test_every_passage_within_the_budget_is_found(spark):
    rng = random.Random(4)
    words = ["the", "of", "stone", "river", "éclair", "and", "walked", "under", "seven", "quietly"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(4, 30)))) for i in range(25)]
    docs = []
    for doc in range(150):
        passage = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, len(passage) // 12 + 3)):
            passage[rng.randrange(len(passage))] = rng.choice(["", "q", "zz", " "])
        docs.append((doc, " ".join(rng.choices(words, k=20)) + ", " + "".join(passage).upper() + "\n" + " ".join(rng.choices(words, k=9))))
    want = {}
    for doc, text in docs:
        text = decontaminate.normal(text.encode())
        for item, t in items:
            t = decontaminate.normal(t.encode())
            edits = table_distance(t, text)[0]
            if len(t) >= 20 and edits <= len(t) // 12 or len(t) < 20 and f" {t} " in f" {text} ":
                want[doc, item] = edits
    got = {(r.doc_id, r.item_id): r.edits for r in run(spark, docs, items)}
    assert got.keys() == want.keys() and want
    assert got == want
    # A benchmark in several blocks gives the same.
    assert {(r.doc_id, r.item_id): r.edits for r in run(spark, docs, items, block_letters=300)} == want


def test_query_finds_whole_items_and_leaves_clean_documents(spark):
    got = {(r.doc_id, r.item_id): r for r in op1_benchmark_decontamination(spark, SMALL).collect()}
    docs = {r.doc_id: decontaminate.normal((r.text or "").encode()) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r.item_id: decontaminate.normal(r.text.encode()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if len(x) >= 20 and x in t}
    assert exact and {k for k, r in got.items() if r.edits == 0} == exact
    for (d, i), r in got.items():
        passage = docs[d].split()[r.first_word:r.last_word + 1]
        assert table_distance(items[i], " ".join(passage))[0] == r.edits


def test_odd_rows(spark):
    item = "a passage that should never be seen in training"
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, item.upper() + "!"), (4, "word " * 50_000 + item), (5, "clean text of no interest")]
    items = [(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "clean text")]
    got = sorted(((r.doc_id, r.item_id, r.edits, r.first_word, r.last_word) for r in run(spark, docs, items)), key=str)
    assert got == sorted([(3, 1, 0, 0, 8), (3, 1, 0, 0, 8), (4, 1, 0, 50_000, 50_008), (None, 1, 0, 0, 8),
                          (5, 4, 0, 0, 1)], key=str)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_short_items_are_found_as_whole_words(spark):
    items = [(1, "Ice cream"), (2, "x"), (3, "12"), (4, "..."), (5, "été"), (6, "nineteen letters ab"), (7, "a passage of twenty letters")]
    docs = [(1, "ICE CREAM"), (2, "nice creams"), (3, "(ice) cream, x"), (4, "112 12a"), (5, "12"), (6, "l'ÉTÉ indien"), (7, ""),
            (8, "nineteen letters ab"), (9, "nineteen lettres ab"), (10, "the passage of twenty letters"), (11, "xx")]
    got = sorted((r.doc_id, r.item_id, r.edits, r.first_word, r.last_word) for r in run(spark, docs, items))
    assert got == [(1, 1, 0, 0, 1), (3, 1, 0, 0, 1), (3, 2, 0, 2, 2), (5, 3, 0, 0, 0), (6, 5, 0, 1, 1), (8, 6, 0, 0, 2), (10, 7, 2, 0, 4)] or got[:6] == [
        (1, 1, 0, 0, 1), (3, 1, 0, 0, 1), (3, 2, 0, 2, 2), (5, 3, 0, 0, 0), (6, 5, 0, 1, 1), (8, 6, 0, 0, 2)] and got[6][:2] == (10, 7) and len(got) == 7
