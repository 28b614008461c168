"""Each stage of the pipeline on its own input, against plain versions."""

import corpus_pipeline
from tests.llm.test_minhash import brute
from tests.llm.test_packing import check
from tillstar.llm import decontaminate
from tillstar.llm.common import stored, table

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_one_by_one(spark):
    docs = table(spark, SMALL, "documents")
    given = [docs]
    for name, stage in corpus_pipeline.STAGES:
        given.append(stored(stage(spark, given[-1], SMALL), "test"))
    assert all(df.columns == COLUMNS for df in given[:-1])
    start, told, single, cut, clean = map(rows_of, given[:-1])

    assert told and all(told[d] == start[d] for d in told)
    assert all(not any(c.isalpha() for c in (start[d].text or "")) for d in start.keys() - told.keys())

    groups = brute([(d, r.text) for d, r in told.items()], width=5)
    assert single == {d: told[d] for d, (_, _, kept) in groups.items() if kept}
    assert len(single) < len(told)

    assert cut.keys() <= single.keys()
    seen = set()
    for d in sorted(single):
        before, after = single[d].text.split(), cut[d].text.split() if d in cut else []
        left = iter(before)
        assert all(w in left for w in after)  # only words went
        if d in cut:
            assert cut[d].n_chars == len(cut[d].text) and cut[d][2:4] == single[d][2:4]
        lower = [w.lower() for w in after]
        own = {tuple(lower[i:i + 50]) for i in range(len(lower) - 49)}
        assert not own & seen  # no run of 50 words is in an earlier document
        seen |= {tuple(w.lower() for w in before[i:i + 50]) for i in range(len(before) - 49)}

    items = [decontaminate.normal(r.text.encode()) for r in table(spark, SMALL, "benchmark").collect()]
    for d, r in cut.items():
        text = decontaminate.normal(r.text.encode())
        leaks = any(decontaminate.distance(x, text)[0] <= len(x) // decontaminate.LETTERS_PER_EDIT if len(x) >= decontaminate.LEAST_LETTERS
                    else f" {x} " in f" {text} " for x in items)
        assert (d in clean) == (not leaks)
    assert len(clean) < len(cut)

    packed = given[-1].collect()
    check(packed, 2048)
    assert {r.doc_id for r in packed} == clean.keys()
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()) == sorted(tuple(r) for r in packed)


def test_odd_rows_and_an_empty_table(spark):
    text = "some words of a text that is long enough to tell its language by its letters"
    rows = [(1, text, "en", None, 5, 1), (2, text, "en", "s", None, 1), (3, None, None, None, None, None), (4, "12 !", "en", "s", 4, 2),
            (None, text, "en", "s", 1, 3), (5, "another " + text[::-1], None, "s", 1, 3), (1, text, "en", None, 5, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row int")
    for given, want in ((docs, [1, 5, None]), (docs.limit(0), [])):
        df = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = stored(stage(spark, df, SMALL), "test")
            assert df.columns == docs.columns
        assert sorted((r.doc_id for r in df.collect()), key=str) == want
        packed = corpus_pipeline.STAGES[-1][1](spark, df, SMALL).collect()
        assert sorted((r.doc_id for r in packed), key=str) == want
