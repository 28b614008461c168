"""The byte network: held-out accuracy, gradients against differences, whole documents."""

import random
import zlib

import numpy as np

from tillstar.llm import quality
from tillstar.llm.queries import op5_quality_classifier

SMALL = "/root/testdata/sf0.1"
DOCS = "doc_id bigint, text string, score string"
LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op5_quality_classifier(spark, SMALL).collect()}
    docs = [r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()]
    assert sorted(got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(r.quality, got[r.doc_id].predicted) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()
            if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert sum(a == b == 0 for a, b in held) >= 0.9 * sum(a == 0 for a, _ in held)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    net = quality.Network(rng)
    for p in ("filters", "shift", "weights", "bias"):
        setattr(net, p, getattr(net, p).astype(float))
    chunks, counts = quality.chunks_of([b"some text " * 90, b"short", b""])
    labels = np.asarray([1, 0, 1], float)

    def loss():
        z = net.logits(net.pooled(chunks)[0].astype(float), counts)[0]
        return float(np.mean(np.logaddexp(0, z) - labels * z))

    found = net.gradients(chunks, counts, labels)
    for p, g in zip(net.parameters(), found):
        flat, grads = p.reshape(-1), np.asarray(g).reshape(-1)
        for at in np.argsort(-np.abs(grads))[:6]:
            old = flat[at]
            flat[at] = old + 1e-3
            up = loss()
            flat[at] = old - 1e-3
            down = loss()
            flat[at] = old
            assert abs((up - down) / 2e-3 - grads[at]) < 2e-3


def test_chunks_cover_whole_texts():
    for size in (0, 1, 511, 512, 513, 1024, 5000):
        text = bytes(random.Random(size).choices(range(1, 256), k=size))
        chunks, counts = quality.chunks_of([b"x", text])
        own = chunks[counts[0]:]
        assert len(own) == counts[1] == max(1, -(-size // quality.CHUNK))
        windows = {bytes(c[i:i + quality.WIDTH]) for c in own for i in range(quality.CHUNK)}
        assert {text[i:i + quality.WIDTH] for i in range(size - quality.WIDTH + 1)} <= windows
    # What stands at the very end of a long text changes its score.
    net = quality.Network(np.random.default_rng(0))
    a, b = net.score([b"word " * 20_000, b"word " * 20_000 + b"#$%^&*!!"])
    assert a != b


def test_odd_rows_and_missing_classes(spark):
    rows = [(i, "good plain words here" if i % 2 else "#### $$$$ !!!!", "x") for i in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (None, "words", "x"), (5, "good plain words here", "x"), (102, "words " * 100_000, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 1), (7, None, None), (8, 5, 0), (3, 1, 0), (999, 1, 0)], LABELS)
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == i % 2 for i in range(60)) and by[100].score == by[101].score
    assert not by[None].held_out
    one = quality.classify(docs, labels.filter("quality = 1")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.5
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(docs.limit(0), labels).collect() == []


def plain_score(net, text):
    """The forward pass window by window."""
    data = text + b"\0" * (-len(text) % quality.CHUNK if text else quality.CHUNK) + b"\0" * quality.WIDTH
    pooled = []
    for chunk in range(0, len(data) - quality.WIDTH, quality.CHUNK):
        best = []
        for f in range(quality.FILTERS):
            scores = []
            for at in range(chunk, chunk + quality.CHUNK, quality.STRIDE):
                scores.append(sum(float(net.filters[j][data[at + j]][f]) for j in range(quality.WIDTH)))
            best.append(max(0.0, max(scores) + float(net.shift[f])))
        pooled.append(best)
    mean = [sum(c[f] for c in pooled) / len(pooled) for f in range(quality.FILTERS)]
    top = [max(c[f] for c in pooled) for f in range(quality.FILTERS)]
    z = sum(w * x for w, x in zip(net.weights.tolist(), mean + top)) + float(net.bias[0])
    return 1 / (1 + np.exp(-z))


def test_scores_agree_window_by_window():
    net = quality.fit([b"good plain words here " * 9, b"#### $$$$ !!!! " * 12, b"more words", b"!!"], [1, 0, 1, 0], epochs=2)
    texts = [b"", b"a", b"good words ####", b"x" * 512, b"y!" * 300, "éclair œuf ".encode() * 140]
    for text, got in zip(texts, net.score(texts)):
        assert abs(plain_score(net, text) - got) < 1e-4


def test_long_labelled_texts_are_learned_from(spark):
    long_bad, long_good = "## $$ !! " * 40_000, "plain words " * 30_000
    docs = spark.createDataFrame([(i, long_good if i % 2 else long_bad, "x") for i in range(0, 12)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], LABELS)
    usable = quality.usable_labels(labels, 3, 1)
    learned = quality.sample(docs, usable, 1000)
    assert len(learned) == usable.count() and min(len(t) for _, t, _ in learned) > 1 << 18
    assert len(quality.sample(docs, usable, 2)) == 4
