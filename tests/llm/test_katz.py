"""The language model against a plain dictionary version; probabilities sum to one."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from tillstar.llm import katz
from tillstar.llm.common import fold, text_rows
from tillstar.llm.queries import op6_katz_lm

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, chunk bigint"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def cell(previous):
    number = katz.BEGIN if previous is None else int(katz.word_hashes([previous])[0])
    return int(katz.mix64(np.asarray([number], np.uint64))[0] >> np.uint64(64 - katz.CELL_BITS))


class Plain:
    def __init__(self, rows, folds=10):
        self.words, self.pairs, self.contexts = collections.Counter(), collections.Counter(), collections.Counter()
        self.cell = {}
        for doc, text in rows:
            if doc is not None and zlib.crc32(str(doc).encode()) % folds:
                for c, t in self.steps(text):
                    self.words[t] += 1
                    self.pairs[c, t] += 1
                    self.contexts[c] += 1
        self.total = sum(self.words.values())
        self.dw, self.dp = (self.factors(collections.Counter(x.values())) for x in (self.words, self.pairs))
        left = sum(n * (1 - self.factor(self.dw, n)) for n in self.words.values())
        self.unknown = min(0.5, max(left, 0.5) / self.total) if self.total else 1.0
        self.kept = self.total - left
        self.seen = collections.defaultdict(list)
        for (c, t), n in self.pairs.items():
            self.seen[c].append((t, n))

    def steps(self, text):
        previous = None
        for t in tokens(text):
            if previous not in self.cell:
                self.cell[previous] = cell(previous)
            yield self.cell[previous], t
            previous = t

    @staticmethod
    def factors(n):
        for most in (5, 4, 3, 2, 1):
            if all(n[r] for r in range(1, most + 2)):
                a = (most + 1) * n[most + 1] / n[1]
                if a < 1:
                    d = [((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) for r in range(1, most + 1)]
                    if all(0 < x < 1 for x in d):
                        return d
        return [0.5]

    @staticmethod
    def factor(d, n):
        return d[n - 1] if n <= len(d) else 1.0

    def word(self, t):
        n = self.words[t]
        return n * self.factor(self.dw, n) * (1 - self.unknown) / self.kept if n else self.unknown

    def probability(self, c, t):
        if not self.contexts[c]:
            return self.word(t)
        n = self.contexts[c]
        kept = sum(k * self.factor(self.dp, k) for _, k in self.seen[c])
        target = kept if kept < n - 1e-9 else n - 0.5
        if self.pairs[c, t]:
            return self.pairs[c, t] * self.factor(self.dp, self.pairs[c, t]) * target / kept / n
        return (1 - target / n) / (1 - sum(self.word(w) for w, _ in self.seen[c])) * self.word(t)


def agree(got, rows):
    plain = Plain(rows)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    for doc, text in rows:
        r, t = by[doc], tokens(text)
        assert r.held_out == (doc is None or zlib.crc32(str(doc).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(plain.words[x] > 0 for x in t), plain.total)
        base = sum(math.log10((plain.words[x] + 0.1) / (plain.total + 0.1 * (len(plain.words) + 1))) for x in t)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        memo = {s: plain.probability(*s) for s in set(plain.steps(text))}
        assert math.isclose(r.score, sum(math.log10(memo[s]) for s in plain.steps(text)), rel_tol=1e-9)
    return plain


@pytest.mark.parametrize("options", [
    {}, {"bucket_bytes": 3000, "chunk_tokens": 300}, {"bucket_bytes": 9000, "chunk_tokens": 200, "chunks_together": 3}])
def test_agrees_with_dictionaries(spark, options):
    rng = random.Random(12)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \n"), (None, "w1 W2"), (7, rows[7][1]), (503, "never seen words")]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    plain = agree(katz.score_texts(df, **options).collect(), rows)
    for c in list(plain.contexts)[:40]:  # of the plain version, and so of the model
        total = sum(plain.probability(c, t) for t in plain.words) + plain.probability(c, "unknown")
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_query_beats_the_base_on_texts_it_has_not_seen(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op6_katz_lm(spark, SMALL).collect()
    agree(got, rows)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_every_context_of_the_stored_model_sums_to_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = text_rows(docs, "doc_id", (fold("doc_id", 10) == 0).alias("held_out"))
    model, numbers = katz.train(rows, 3, 20_000)
    buckets = [katz.Bucket(r.asDict()) for r in model.collect()]
    assert len(buckets) == 3 and sum(len(b.words) for b in buckets) == numbers.types
    likely = np.concatenate([numbers.word(b.totals) for b in buckets])
    assert math.isclose(likely.sum() + numbers.unknown, 1, rel_tol=1e-9)
    for c in (cell(None), cell(b"the"), cell(b"of"), cell(b"de"), 77):
        total = numbers.token(np.zeros(1, int), np.zeros(1, int), np.asarray([c]))[0]
        for b in buckets:
            pair = np.zeros(len(b.words), np.int64)
            own = b.cells == c
            pair[b.word[own]] = b.counts[own]
            total += numbers.token(b.totals, pair, np.full(len(pair), c)).sum()
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_nothing_to_learn_and_an_empty_table(spark):
    (r,) = katz.score_texts(spark.createDataFrame([(None, "some words", 1)], SCHEMA)).collect()
    assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.score) == (None, True, 3, 0, 0, 0.0)
    assert katz.score_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_few_counts_still_leave_something_for_new_words():
    assert katz.discounts([0] * 6).tolist() == [0.0, 0.5]
    assert katz.discounts([5, 0, 0, 0, 0, 0]).tolist() == [0.0, 0.5]
    found = katz.discounts([1000, 400, 200, 110, 70, 45])
    assert len(found) == 6 and all(0 < d < 1 for d in found[1:])


def test_a_very_frequent_word_is_asked_for_in_several_tasks(spark, monkeypatch):
    """Half of all tokens are one word: its entries are dealt to tasks by chunk, and scores stay those of the dictionaries."""
    sent = []
    monkeypatch.setattr(katz, "stored", lambda df, label, keep=katz.stored: sent.append((label, keep(df, label))) or sent[-1][1])
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", f"w{rng.randrange(300)}"]) for _ in range(60))) for i in range(120)]
    got = katz.score_texts(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), chunk_tokens=400, chunks_together=2).collect()
    agree(got, rows)
    combined = dict(sent)["combined"]
    assert combined.groupBy("bucket").count().agg({"count": "max"}).first()[0] > 5


def test_contexts_are_words_and_not_cells_of_them(spark):
    """Two words that share the first 16 bits of their hash, after which different words follow, stay two contexts."""
    found = {}
    for i in range(5000):
        word = f"w{i}"
        top = int(katz.mix64(katz.word_hashes([word.encode()]))[0]) >> 48
        other = found.setdefault(top, word)
        if other != word:
            break
    assert other != word
    rows = [(i, f"{other} one") for i in range(40)] + [(100 + i, f"{word} two") for i in range(40)] + [(200, f"{word} one"), (201, f"{other} one")]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = {r.doc_id: r.score for r in katz.score_texts(df, folds=3).collect()}
    train = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 3]
    pairs = collections.Counter((a, b) for _, t in train for a, b in [t.split()])
    assert pairs[other, "one"] > 10 and pairs[word, "two"] > 10
    # "one" after the other word is as likely as that; after this word, which it hardly ever follows, it is not
    assert got[200] < got[201] - 0.5


def test_a_model_keeps_weights_in_a_table(spark):
    """More contexts than would fit the numbers that tasks get: those hold no array that grows with contexts."""
    text = " ".join(f"v{i}" for i in range(70_000))
    rows = text_rows(spark.createDataFrame([(1, text, 1)], SCHEMA), "doc_id", (fold("doc_id", 10) == 0).alias("held_out"))
    model, numbers = katz.train(rows, 2, 1 << 20)
    assert numbers.types == 70_001 and numbers.weights.count() == 70_001  # the begin and every word
    assert sum(np.asarray(v).size for v in vars(numbers.numbers()).values()) < 50
