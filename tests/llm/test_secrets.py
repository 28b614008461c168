"""Secret scans: patterns letter by letter, inferred automata on known formats and on held-out credentials."""

import hashlib
import math
import random
import string

from pyspark.sql import functions as F

from tillstar.llm import secrets
from tillstar.llm.queries import op11_secret_scan

SMALL = "/root/testdata/sf0.01"
VALUE = set(string.ascii_letters + string.digits + "+/_.=-")


def stretches(text, letters, start=0):
    at = start
    while at < len(text):
        end = at
        while end < len(text) and text[end] in letters:
            end += 1
        if end > at:
            yield at, end
        at = max(end, at + 1)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_base(text):
    """Kind, begin and end, without regular expressions."""
    out, at, low = [], 0, lower(text)
    while at < len(text):
        end = None
        for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if not low.startswith(word, at):
                continue
            i = at + len(word)
            i += text[i:i + 1] in ('"', "'") and i < len(text)
            while text[i:i + 1] == " ":
                i += 1
            if text[i:i + 1] not in (":", "=") or i >= len(text):
                continue
            first = i + 1
            i = first
            while text[i:i + 1] == " ":
                i += 1
            i += text[i:i + 1] in ('"', "'") and i < len(text)
            stop = i
            while stop < len(text) and text[stop] in VALUE:
                stop += 1
            if stop > i:
                end = stop
                if stop - i >= 6:
                    out.append(("assign", at, stop))
                break
        at = end or at + 1
    at = text.find("AKIA")
    while at >= 0:
        end = at + 4
        while end < len(text) and text[end] in string.ascii_uppercase + string.digits:
            end += 1
        if end - at >= 20:
            out.append(("access", at, end))
        at = text.find("AKIA", end if end > at + 4 else at + 1)
    out += [("hex", a, b) for a, b in stretches(text, set("0123456789abcdef")) if b - a >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_query_agrees_letter_by_letter(spark):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = op11_secret_scan(spark, SMALL)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = plain_base(docs[r.doc_id] or "")
        kinds = [k for k, _, _ in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(listed(base).split(",")) - {""} <= set(spans)
        assert all(s.startswith("grammar:") for s in set(spans) - set(listed(base).split(",")))
    assert sum(r.n_assign + r.n_hex for r in rows) > 5


def test_patterns_on_awkward_texts():
    texts = [
        "", "token token=abcdef", 'API_KEY\'  :  "ab.c=d/", apikey:12345 PassWord=="x', "ſecret=abcdefg", "toKen=abcdef",
        "toKen=abcdefgh", "AKIA" * 6, "AKIAABCAKIA" + "X" * 20, "AKIAx" + "AKIA" + "B" * 15 + " AKIA" + "B" * 16,
        "f" * 23 + "g" + "e" * 24, "secret: token: abcdefg", "passwd =\"secretsecret\"", "é" * 5 + "token=" + "a" * 30 + "é",
        "password=secret=tokens=abcdef", "secret =\n abcdefg", "apikeyapi_key=123456", "token='" + "0" * 24 + "'"]
    rng = random.Random(5)
    bits = ["password", "Token", "api_key", "=", ":", " ", '"', "'", "AKIA", "AB12", "deadbeef", "0123456789ab", "é", "\n", "x.y", "a"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    for text in texts:
        assert [s[:3] for s in secrets.base_spans(text)] == plain_base(text), text


def test_known_automaton_is_recovered():
    rng = random.Random(7)

    def draw():
        return "k-" + "".join(rng.choice("01") for _ in range(rng.choice([6, 8]))) + rng.choice(["x", "yy"])

    samples = [draw() for _ in range(3000)]
    automaton = secrets.infer(samples)
    assert sum(automaton.ended) == 3000
    # k and - stand in states of their own with one letter only.
    first = automaton.step[0]
    assert set(automaton.counts[0]) == {"k"} and set(automaton.counts[first["k"]]) == {"-"}
    shuffled = samples[:]
    rng.shuffle(shuffled)
    again = secrets.infer(shuffled)
    assert again.step == automaton.step and again.counts == automaton.counts
    good, bad = automaton.score("k-010110x"), automaton.score("kx010110-")
    assert good > bad + 10
    # A probability: the sum over all texts of a small alphabet does not exceed one.
    texts = [""]
    total = 0.0
    for _ in range(6):
        total += sum(math.exp(automaton.score(t)) for t in texts)
        texts = [t + x for t in texts for x in "k-01xy"]
    assert total <= 1.0


def test_merging_needs_equal_shares():
    """The next letter depends on the state: a merged automaton keeps the two apart."""
    rng = random.Random(8)
    samples = ["".join("ab"[(i + j) % 2] for i in range(rng.randint(2, 12))) for j in (0,) * 2000]
    automaton = secrets.infer(samples)
    assert automaton.score("abababab") > automaton.score("aaaaaaaa") + 10
    assert len(automaton.step) < 14


def test_held_out_credentials(spark):
    """Credentials without any keyword are found by the formats learned from those with one, prose is not."""
    rng = random.Random(9)
    letters = string.ascii_letters + string.digits
    key = lambda: "zk_" + "".join(rng.choice(letters) for _ in range(30))
    words = lambda n: " ".join("".join(rng.choice(["la", "ti", "ren", "os", "um"]) for _ in range(rng.randint(2, 11))) for _ in range(n))
    rows = [(i, f"{words(20)} token = \"{key()}\" {words(20)}") for i in range(400)]
    rows += [(1000 + i, f"{words(20)} see {key()} {words(20)}") for i in range(200)]
    rows += [(2000 + i, words(60)) for i in range(200)]
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    texts = dict(rows)
    hits = [got[1000 + i] for i in range(200)]
    assert sum(r.n_grammar == 1 and r.n_assign == 0 for r in hits) >= 198
    for r in hits:
        for s in r.found:
            assert texts[r.doc_id][s.start:s.end].startswith("zk_") and s.score >= secrets.EVIDENCE
    assert sum(got[2000 + i].n_grammar for i in range(200)) == 0
    # The same from labelled samples of the caller.
    labelled = spark.createDataFrame(
        [("zk", key()) for _ in range(300)] + [("plain", w) for w in words(3000).split() if len(w) >= 16], "kind string, value string")
    again = secrets.scan(spark.createDataFrame(rows[400:600], "doc_id bigint, text string"), labelled=labelled)
    assert again.filter("n_grammar = 1").count() >= 198


def test_rows_of_all_kinds(spark):
    rows = [(1, None, "z"), (2, "", "z"), (3, "é token=abcdef0 é", "z"), (3, "é token=abcdef0 é", "z"), (None, "AKIA" + "Z" * 16, "z"),
            (4, "x" * 3_000_000 + " secret:" + "q" * 100, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = secrets.scan(df).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[3].spans == "assign:2:15" and sum(r.doc_id == 3 for r in got) == 2
    assert by[1].spans == by[2].spans == "" and by[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].spans == "access:0:20" and by[4].spans.split(",")[0].startswith("assign:3000001:")
    assert secrets.scan(df.limit(0)).count() == 0


def test_sample_is_bounded_and_uniform(spark):
    df = spark.range(30000).select(F.lit("a").alias("kind"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"))
    few = df.union(spark.range(10).select(F.lit("b"), F.col("id").cast("string")))
    picked = secrets.sampled(few.union(few), 1000).collect()
    assert sum(r.kind == "a" for r in picked) == 1000 and sum(r.kind == "b" for r in picked) == 10
    mean = sum(int(r.value[1:]) for r in picked if r.kind == "a") / 1000
    assert 13500 < mean < 16500
