"""Language identification: held-out accuracy, and a plain Bayes computation of one text."""

import math
import zlib

from tillstar.llm import language
from tillstar.llm.queries import op7_language_id

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, score double"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op7_language_id(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert set(got) == {d.doc_id for d in docs}
    for d in docs:
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0)
    held = [d for d in docs if got[d.doc_id].held_out and d.lang]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def plain_cells(text, cells):
    """The n-gram cells of a text, one character at a time."""
    chars = [c if c.isalpha() else " " for c in "\n" + text.lower() + "\n"]
    out = []
    for n in language.ORDERS:
        for i in range(len(chars) - n + 1):
            gram = chars[i:i + n]
            if any(c.isalpha() for c in gram):
                state = n
                for c in gram:
                    state = (state ^ ord(c)) * 0x9E3779B1 % 2**32
                    state ^= state >> 15
                out.append((state * 0x85EBCA6B % 2**32 >> 8) % cells)
    return out


def test_scores_agree_with_plain_bayes(spark):
    texts = ["the cat, THE hat", "le chat et l'été", "der Hund und ß", "the dog", "la forêt", "die Katze"]
    rows = [(i, t, lang, 0.5) for i, (t, lang) in enumerate(zip(texts * 3, ["en", "fr", "de"] * 6))]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, SCHEMA), cells=512).collect()}
    counts, docs = {}, {}
    for i, t, lang, _ in rows:
        if zlib.crc32(str(i).encode()) % 5:
            docs[lang] = docs.get(lang, 0) + 1
            own = counts.setdefault(lang, [0] * 512)
            for c in plain_cells(t, 512):
                own[c] += 1
    for i, t, _, _ in rows:
        logs = {}
        for lang, own in counts.items():
            total = sum(own) + 0.5 * 512
            logs[lang] = math.log(docs[lang] / sum(docs.values())) + sum(
                math.log((own[c] + 0.5) / total) for c in plain_cells(t, 512))
        best = max(sorted(logs), key=logs.get)
        share = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
        assert got[i].lang_pred == best and math.isclose(got[i].score, share, rel_tol=1e-9)


def test_nulls_and_texts_without_letters(spark):
    rows = [(i, "some english words here", "en", 1.0) for i in range(20)] + [(50, None, "en", None), (51, "", None, None), (52, "12 345 !?", "en", None),
            (None, "words", "en", None), (53, "english " * 100_000, None, None), (3, "some english words here", "en", 1.0)]
    got = language.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[50] == by[51] == by[52] == ("und", 0.0)
    assert by[53] == by[None] == by[3] == ("en", 1.0)
    assert [r.held_out for r in got if r.doc_id is None] == [True]


def test_nothing_to_learn_and_empty_table(spark):
    got = language.identify(spark.createDataFrame([(1, "words", None, None)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert language.identify(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_table_of_weights_is_bounded_by_the_number_of_languages(spark, monkeypatch):
    import pytest

    from tillstar.llm import language

    docs = spark.createDataFrame([(i, f"text number {i}", f"l{i % 7}") for i in range(100)], "doc_id bigint, text string, lang string")
    monkeypatch.setattr(language, "MOST_LANGUAGES", 7)
    assert language.identify(docs).count() == 100
    monkeypatch.setattr(language, "MOST_LANGUAGES", 6)
    with pytest.raises(ValueError):
        language.identify(docs)
