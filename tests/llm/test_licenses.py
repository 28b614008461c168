"""Licence scans against a word-by-word search and a whole-text fuzzy match."""

import random
import re

import regex

from tillstar.llm import licenses
from tillstar.llm.queries import op3_license_scan

SMALL = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    hits = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in hits]
    return (len(words), len(hits), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in hits}))), words


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id bigint, text string, spans string")
    return {r.doc_id: r for r in licenses.scan(df, **options).collect()}


def as_base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_query_agrees_word_by_word(spark):
    got = {r.doc_id: r for r in op3_license_scan(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert as_base(got[d.doc_id]) == base(d.text)[0]
        assert set(got[d.doc_id].base_labels.split(",")) - {""} <= set(got[d.doc_id].labels.split(","))
    with_cc = [d for d in docs if "CC BY-NC 4.0" in d.text]
    assert with_cc and all("cc-by-nc" in got[d.doc_id].labels.split(",") for d in with_cc)
    # Texts without any notice stay clean.
    assert sum(r.labels != "" for r in got.values()) == sum("icense" in d.text for d in docs)


def test_every_fuzzy_passage_is_found(spark):
    rng = random.Random(9)
    notices = list(licenses.NOTICES)
    rows = []
    for doc in range(400):
        text = list(rng.choice(notices))
        for _ in range(rng.randint(0, len(text) // licenses.LETTERS_PER_EDIT + 2)):
            at = rng.randrange(len(text))
            rng.choice([lambda: text.pop(at), lambda: text.insert(at, rng.choice("abc ")),
                        lambda: text.__setitem__(at, rng.choice("xyz")), ])()
        rows.append((doc, "Some words before, " + "".join(text) + rng.choice([".", "\nand more", ""])))
    got = run(spark, rows, telling=frozenset())
    for doc, text in rows:
        joined = " " + " ".join(base(text)[1]) + " "
        want = {label for n, label in licenses.NOTICES.items()
                if regex.search(f"(?:{regex.escape(n)}){{e<={len(n) // licenses.LETTERS_PER_EDIT}}}", joined)}
        want |= set(base(text)[0][4].split(",")) - {""}
        assert got[doc].labels == ",".join(sorted(want)), text
        assert (got[doc].score > 0) == bool(want) and 0 <= got[doc].score <= 1


def test_spans_and_edge_cases(spark):
    line = "Released under the MIT License. "
    rows = [(1, None), (2, ""), (3, " \n"), (4, line * 3000), (5, "rmit license mit licensed"), (6, "MIT\tLicense, APACHE  license; général public licence"),
            (7, "x y Licenced under the Apache Licence, Version 2.0!"), (8, "mit license mit license")]
    got = run(spark, rows)
    assert as_base(got[1]) == as_base(got[2]) == as_base(got[3]) == (0, 0, None, None, "")
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (3000, 3, 14998) and len(got[4].spans) == 3000
    assert got[4].spans[1].first == 5 and got[4].spans[1].last == 9
    assert got[5].n_base == 0 and got[6].base_labels == "apache,mit"
    assert (got[7].base_labels, got[7].labels, got[7].spans[0].first, got[7].spans[0].edits) == ("", "apache", 2, 2)
    assert got[8].n_base == 2 and got[8].last_word == 2
    assert run(spark, []) == {}


def test_only_the_licence_that_is_meant_is_named(spark, tmp_path):
    texts = {
        "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under CC BY-SA 4.0.": "cc-by-sa", "Licensed under CC BY-ND 4.0.": "cc-by-nd",
        "Licenced under CC BY NC 4.0": "cc-by-nc", "Licensed under CC BY-NC 3.0.": "", "Licensed under CC BY 4.0.": "cc-by",
        "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0.": "cc-by-nc,cc-by-sa", "released under the mpl license": "mpl",
        "Released under the MIT License.": "mit", "Released under teh MIT license": "mit", "released under the isc license": "isc",
        "Licenced under the Apache Licence, Version 2.0": "apache", "licensed under the apache license version 1.1": "apache",
        "this work is licenced under the gnu general public licence version 3": "gpl",
        "this work is licenced under the gnu general public licence version 2": "", "nothing of that kind": ""}
    folder = str(tmp_path)
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in op3_license_scan(spark, folder).collect()}
    assert {text: got[i].labels for i, text in enumerate(texts)} == texts
    assert [(s.label, s.first, s.last, s.edits) for s in got[0].spans] == [("cc-by-nc", 0, 6, 0)]
    assert got[4].spans == [] and got[4].score == 0


def test_the_query_names_no_licence_that_is_not_there(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r.labels.split(",") for r in op3_license_scan(spark, SMALL).collect()}
    for label, text in (("cc-by-nc", "CC BY-NC 4.0"), ("cc-by-sa", "CC BY-SA 4.0")):
        assert {d for d in docs if label in got[d]} == {d for d, t in docs.items() if text in (t or "")}


def test_of_overlapping_spans_those_with_the_fewest_edits_stay():
    a, b = licenses.Notice("aa bb", "a", 12), licenses.Notice("aa cc", "b", 12)
    assert licenses.winners([(0, 9, 2, a), (5, 12, 1, b), (12, 20, 2, a)]) == [(5, 12, 1, b), (12, 20, 2, a)]
    assert licenses.winners([(0, 9, 1, a), (0, 9, 1, b)]) == [(0, 9, 1, a), (0, 9, 1, b)]
    assert licenses.winners([]) == []


def test_each_notice_names_its_own_licence(spark):
    texts = {n: label for n, label in licenses.NOTICES.items()}
    texts |= {
        "SPDX-License-Identifier: MIT": "mit", "// SPDX-License-Identifier: GPL-3.0-or-later": "gpl", "SPDX-License-Identifier: LGPL-2.1": "lgpl",
        "SPDX-Licence-Identifier: Apache-2.0": "apache", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0": "cc-by-nc-sa", "SPDX-License-Identifier: WTFPL": "",
        "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa", "licensed under the BSD 2-Clause Licence": "bsd-2-clause",
        "the GNU lesser general public licence": "", "under the terms of the GNU Lesser General Public Licence": "lgpl",
        "under the terms of the GNU Affero General Publik License": "agpl", "free and unencumbred software released into the public domain": "unlicense"}
    got = run(spark, list(enumerate(f"Some words. {t}; and more." for t in texts)))
    for i, (text, label) in enumerate(texts.items()):
        own = set(got[i].labels.split(",")) - set(got[i].base_labels.split(",")) - {""}
        assert own | ({label} & set(got[i].base_labels.split(",")) - {""}) == {label} - {""}, text
