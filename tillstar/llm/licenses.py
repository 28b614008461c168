"""Licence phrases and fuzzy short notices in texts.

A notice of n letters may differ from a passage by k edits. Cut into k + 1 pieces, at least one piece stands in
the passage unchanged, so exact piece hits locate every candidate; the regex library's bounded-error
matching then verifies each candidate in a window of n + 2k letters.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import text_rows

# Phrases whose words stand consecutively, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Short notices as words, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by nd 4 0": "cc-by-nd",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa",
    "creative commons attribution 4 0 international license": "cc-by",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "creative commons attribution noderivatives 4 0 international license": "cc-by-nd",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "creative commons attribution noncommercial noderivatives 4 0 international license": "cc-by-nc-nd",
    "creative commons attribution noncommercial sharealike 4 0 international license": "cc-by-nc-sa",
    "creative commons cc0 1 0 universal": "cc0",
    "released under the bsd license": "bsd",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "licensed under the bsd 2 clause license": "bsd-2-clause",
    "licensed under the bsd 3 clause license": "bsd-3-clause",
    "released under the isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "released under the mpl license": "mpl",
    "subject to the terms of the mozilla public license": "mpl",
    "free and unencumbered software released into the public domain": "unlicense",
}
# Identifiers of one-line tags, as words, and their labels.
TAGS = {
    "mit": "mit", "apache 2 0": "apache", "isc": "isc", "mpl 2 0": "mpl", "unlicense": "unlicense", "cc0 1 0": "cc0",
    "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause",
    "gpl 2 0": "gpl", "gpl 3 0": "gpl", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "agpl 3 0": "agpl",
    "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc", "cc by nd 4 0": "cc-by-nd",
    "cc by nc sa 4 0": "cc-by-nc-sa", "cc by nc nd 4 0": "cc-by-nc-nd",
}
NOTICES |= {f"spdx license identifier {tag}": label for tag, label in TAGS.items()}
# Words of notices that tell licences apart, among them version numbers.
TELLING = frozenset({
    "mit", "apache", "isc", "mpl", "bsd", "gpl", "lgpl", "agpl", "cc", "cc0", "unlicense", "by", "nc", "nd", "sa", "lesser", "affero",
    "noncommercial", "noderivatives", "sharealike", "0", "1", "2", "3", "4"})
# One edit for so many letters of a notice.
LETTERS_PER_EDIT = 12

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text, ASCII letters lowered; digits and everything beyond ASCII belong to words."""
    return (text or b"").translate(_WORDS).split()


def _pattern(words: list[str], edits: int, telling: frozenset[str]) -> bytes:
    """Words with errors in between those that stand unchanged, as whole words."""
    parts: list[bytes] = []
    for unchanged, run in itertools.groupby(words, telling.__contains__):
        text = regex.escape(" ".join(run).encode(), literal_spaces=True)
        parts.append(b"(?<= )" + text + b"(?= )" if unchanged else b"(?:" + text + b"){e<=%d}" % edits)
    return b"(?b)" + b" ".join(parts)


class Notice:
    def __init__(self, words: str, label: str, letters_per_edit: int, telling: frozenset[str] = frozenset()):
        self.words, self.label, self.text = words, label, words.encode()
        self.edits = len(self.text) // letters_per_edit
        count, size = self.edits + 1, len(self.text)
        cuts = [size * i // count for i in range(count + 1)]
        self.pieces = [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.beyond = int(words.split(" ")[-1] in telling)
        self.pattern = regex.compile(_pattern(words.split(" "), self.edits, telling))

    def candidates(self, text: bytes) -> list[int]:
        """Where the notice would begin, for each exact hit of a piece."""
        found = set()
        for piece, offset in self.pieces:
            at = text.find(piece)
            while at >= 0:
                found.add(at - offset)
                at = text.find(piece, at + 1)
        return sorted(found)

    def spans(self, text: bytes) -> Iterator[tuple[int, int, int]]:
        """Begin, end and edits of passages within the allowed edits, left to right."""
        done = 0
        for at in self.candidates(text):
            if at < done - self.edits:
                continue  # another piece of the passage just found
            low = max(0, at - self.edits, done)
            # A word that must stand unchanged is followed by a blank, maybe just beyond the passage.
            window = text[low:at + len(self.text) + self.edits + self.beyond]
            match = self.pattern.search(window)
            if match and sum(match.fuzzy_counts) <= self.edits:
                begin, done = low + match.start(), low + match.end()
                yield begin, done, sum(match.fuzzy_counts)


def winners(spans: list[tuple[int, int, int, Notice]]) -> list[tuple[int, int, int, Notice]]:
    """Spans (begin, end, edits, notice) that overlap none of another label with fewer edits."""
    kept: list[tuple[int, int, int, Notice]] = []
    by_begin: list[tuple[int, int, int, Notice]] = []
    longest = max((end - begin for begin, end, *_ in spans), default=0)
    for span in sorted(spans, key=lambda s: s[2]):
        begin, end, edits, notice = span
        near = by_begin[bisect.bisect_left(by_begin, begin - longest, key=lambda s: s[0]):
                        bisect.bisect_left(by_begin, end, key=lambda s: s[0])]
        if not any(other[1] > begin and other[2] < edits and other[3].label != notice.label for other in near):
            kept.append(span)
            bisect.insort(by_begin, span, key=lambda s: s[0])
    return kept


def _scan(phrases: dict[str, str], notices: dict[str, str], letters_per_edit: int, telling: frozenset[str]):
    span = pa.struct([("notice", pa.string()), ("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                      ("edits", pa.int64())])
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(span))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
        fuzzy = [Notice(n, label, letters_per_edit, telling) for n, label in notices.items()]
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                # A blank on either side, so that a phrase is found as whole words.
                joined = b" " + b" ".join(words) + b" "
                places, base = [], set()
                for phrase, label in exact:
                    at = joined.find(phrase)
                    while at >= 0:
                        places.append(at)
                        base.add(label)
                        at = joined.find(phrase, at + 1)
                spans, best = [], 1.0 if base else 0.0
                hits = [(*hit, notice) for notice in fuzzy for hit in notice.spans(joined)]
                for begin, end, edits, notice in winners(hits) if telling else hits:
                    spans.append({
                        "notice": notice.words, "label": notice.label, "edits": edits,
                        "first": max(0, joined.count(b" ", 0, begin + 1) - 1),
                        "last": max(0, joined.count(b" ", 0, max(begin + 1, end - 1)) - 1)})
                    best = max(best, 1 - edits / len(notice.text))
                labels = base | {s["label"] for s in spans}
                rows.append((
                    doc, len(words), len(places), joined.count(b" ", 0, min(places)) if places else None,
                    joined.count(b" ", 0, max(places)) if places else None, ",".join(sorted(base)),
                    ",".join(sorted(labels)), best, spans))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return scan


def scan(
    docs: DataFrame, *, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None,
    letters_per_edit: int = LETTERS_PER_EDIT, telling: frozenset[str] = TELLING,
) -> DataFrame:
    """Licence labels of every whole text.

    The words ``telling`` of a notice must stand unchanged, and of overlapping spans of different labels those with
    the fewest edits stay. With an empty set, every notice within its edits counts, also one that differs from another licence's by
    no more than these.

    ``doc_id, n_words, n_base`` (places of all phrases), ``first_word, last_word`` (smallest and
    largest of their starts, else null), ``base_labels, labels`` (sorted, comma-joined, empty if there are none),
    ``score`` (1 with a phrase, else the share of unedited letters of the best notice, else 0)
    and ``spans`` (notice, label, first and last word, edits).

    Null and empty texts have no words. Repeated rows and rows without doc_id are scanned each; other columns
    are not read. An empty table gives no rows.
    """
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    return text_rows(docs, ids).mapInArrow(
        _scan(PHRASES if phrases is None else phrases, NOTICES if notices is None else notices, letters_per_edit, telling),
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, "
        "spans array<struct<notice: string, label: string, first: bigint, last: bigint, edits: bigint>>")
