"""Packing against the tokenizer itself and the laws of a packing."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tillstar.llm import packing
from tillstar.llm.queries import op8_best_fit_packing, tokenizer_file

SMALL = "/root/testdata/sf0.001"
ODD = ["", " \n", "it's we'LL 'S don't've", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>X", "***%%% foo,,, bar!'s x','y",
       "ÀÉÎ ÇA È ß ẞ İ ΣΑΣ", "éa ́b 12 3a4 ½ ² 漢字かな Ωmega", " nbsp em line", "tab\tnew\x0bvt\x0cff\rcr",
       "\x1cfs\x1dgs\x85nel", "it’s naïve​zero", "A" * 3000, "😀 emoji😀x,", "x.y,z; (a) [b] {c} #d e#", "ſ K Å", "don't.", "'tis", "a'", "b',"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_file())


def test_ids_are_those_of_the_tokenizer(tokenizer):
    rng = random.Random(3)
    alphabet = list("abcXYZ01 '.,!*\n\té́ßΣ<|>&") + ["'s", "'LL", " the ", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    ids, ends = packing.WordIds(tokenizer_file()).texts([t.encode() for t in texts], 0)
    begin = 0
    for text, end in zip(texts, ends.tolist()):
        assert ids[begin:end].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0], repr(text)
        begin = end


def test_memory_of_words_may_run_over(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 5)
    coder = packing.WordIds(tokenizer_file())
    for text in ("one two three four", "five six seven eight", "one nine"):
        ids, _ = coder.texts([text.encode()], 7)
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [7]


def check(rows, capacity):
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_query(spark, tokenizer):
    got = op8_best_fit_packing(spark, SMALL).collect()
    want, total = [], 0
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.asarray(ids[at:at + 2048], "<u4")
            want.append((r.doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(r[:5] for r in got) == sorted(want)
    assert check(got, 2048) <= 1.02 * math.ceil(total / 2048) + 1


def test_plan_places_every_piece_once():
    rng = random.Random(5)
    for capacity in (1, 2, 7, 40, 200):
        for _ in range(40):
            counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(0, 25))}
            used = collections.Counter()
            patterns = packing.plan(counts, capacity)
            for pattern, n in patterns:
                assert sum(pattern) <= capacity and n > 0
                for length in pattern:
                    used[length] += n
            assert used == collections.Counter(counts)
            # Best fit alone leaves at most one sequence half empty or less.
            total = sum(k * v for k, v in counts.items())
            assert sum(n for _, n in patterns) <= 2 * total / capacity + 1


def test_exact_complements_fill_sequences():
    assert packing.plan({5: 2, 3: 2, 2: 1, 1: 1}, 8) == [((5, 3), 2), ((2, 1), 1)]
    assert packing.plan({4: 3, 6: 1}, 10) == [((6, 4), 1), ((4, 4), 1)]
    assert packing.plan({5: 10, 2: 10, 1: 10}, 10)[0] == ((5, 5), 5)
    assert sum(n for _, n in packing.plan({7: 4, 1: 12}, 10)) == 4


def test_nulls_copies_long_texts_and_clashing_names(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "x y", "c"), (3, "word " * 5000, "d")] + [(4, "hot copy of a text", "e")] * 500
    df = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    got = packing.pack(df, tokenizer_file(), capacity=16).collect()
    check(got, 16)
    assert len([r for r in got if r.doc_id == 4]) == 500
    assert [r.length for r in got if r.doc_id == 3] .count(16) == 312
    assert sorted((r.doc_id, r.length) for r in got if r.doc_id in (1, 2)) == [(1, 1), (2, 1)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(df, tokenizer_file()).collect() == []


def test_a_triple_goes_on_to_the_next_pair_when_a_length_has_run_out():
    left = np.zeros(11, np.int64)
    left[[4, 2, 3]] = 1, 1, 2
    assert packing._complement(10, left) == [4, 3, 3] and left[[4, 2, 3]].tolist() == [1, 1, 2]
    rng = np.random.default_rng(6)
    for _ in range(400):
        gap = int(rng.integers(3, 16))
        left = rng.integers(0, 3, gap + 1) * (rng.random(gap + 1) < 0.4)
        left[0] = 0
        pool = np.repeat(np.arange(gap + 1), left).tolist()
        fits = any(sum(c) == gap for n in (1, 2, 3) for c in itertools.combinations(pool, n))
        found = packing._complement(gap, left)
        assert (found is not None) == fits
        assert found is None or (sum(found) == gap and packing._times(found, left) >= 1)
