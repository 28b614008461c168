"""Secrets in texts: plain patterns, and formats learned by grammar inference from the credentials these find."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import stored, text_rows

KINDS = ("assign", "access", "hex", "grammar")
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
LEAST_LETTERS = {"assign": 6, "access": 20, "hex": 24}

# A candidate is a whole stretch of these letters, so many at least.
CANDIDATE_LETTERS = 16
# Distinct strings of each kind that automata are inferred from, of so many letters at most. Scoring reads all strings whole.
SAMPLE = 1000
LONGEST = 256
# Confidence of the compatibility test: smaller merges more.
ALPHA = 0.05
# A candidate is a secret when its format is so much likelier under some credential automaton than under that of
# plain strings (natural logarithm; 9 is 8,000 to one).
EVIDENCE = 9.0
PLAIN = "plain"


class Automaton:
    """A probabilistic automaton: counts of letters and ends for each state, and the next state for each letter."""

    def __init__(self, step: list[dict[str, int]], counts: list[Counter], ended: list[int]):
        self.step = step
        self.counts, self.ended = counts, ended
        letters = Counter()
        for c in counts:
            letters.update(c)
        total, kinds = sum(letters.values()), 1 + len(letters)
        # Letters that a state has not seen share one count, by how common they are in all states.
        common = {x: (n + 1) / (total + kinds) for x, n in letters.items()}
        self.unseen = math.log(1 / (total + kinds))
        self.logs: list[dict[str, float]] = []
        self.others: list[float] = []
        self.ends: list[float] = []
        for c, end in zip(counts, ended):
            size = sum(c.values()) + end + 1
            self.logs.append({x: math.log((c[x] + p) / size) for x, p in common.items()})
            self.others.append(self.unseen - math.log(size))
            self.ends.append(math.log((end + 1 / kinds) / size))

    def score(self, text: str) -> float:
        """The logarithm of the probability of the text. A letter that a state has not seen leads to the first state."""
        state, total = 0, 0.0
        for x in text:
            logs = self.logs[state]
            total += logs[x] if x in logs else self.others[state]
            state = self.step[state].get(x, 0)
        return total + self.ends[state]


def infer(samples: Iterable[str], alpha: float = ALPHA) -> Automaton:
    """State merging on the prefix tree of the samples.

    States proven to differ are kept; the most visited state below them is merged into the first kept state that it
    is compatible with, or else kept. Two states are compatible when the shares of ends and of each letter differ by no more than
    the Hoeffding bound, and so do all pairs of states that the same letters lead to. Merging folds the tree
    below one state into the automaton from the other on. The order of samples does not matter.
    """
    step: list[dict[str, int]] = [{}]
    counts, ended = [Counter()], [0]
    for text in sorted(samples):
        state = 0
        for x in text:
            counts[state][x] += 1
            if x not in step[state]:
                step[state][x] = len(step)
                step.append({})
                counts.append(Counter())
                ended.append(0)
            state = step[state][x]
        ended[state] += 1
    visits = [sum(c.values()) + e for c, e in zip(counts, ended)]
    width = math.sqrt(0.5 * math.log(2 / alpha))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if not visits[a] or not visits[b]:
                continue
            bound = width * (1 / math.sqrt(visits[a]) + 1 / math.sqrt(visits[b]))
            if bound >= 1:
                continue  # too few to tell anything, and below them fewer still
            if abs(ended[a] / visits[a] - ended[b] / visits[b]) > bound:
                return False
            for x in counts[a].keys() | counts[b].keys():
                if abs(counts[a][x] / visits[a] - counts[b][x] / visits[b]) > bound:
                    return False
                if x in step[a] and x in step[b]:
                    todo.append((step[a][x], step[b][x]))
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            counts[a].update(counts[b])
            ended[a] += ended[b]
            visits[a] += visits[b]
            for x, below in step[b].items():
                if x in step[a]:
                    todo.append((step[a][x], below))
                else:
                    step[a][x] = below

    kept = [0]
    known = {0}
    while True:
        below = [(-visits[t], t, s, x) for s in kept for x, t in step[s].items() if t not in known]
        if not below:
            break
        _, state, parent, letter = min(below)
        into = next((k for k in kept if compatible(k, state)), None)
        if into is None:
            kept.append(state)
            known.add(state)
        else:
            step[parent][letter] = into
            fold(into, state)
    number = {s: i for i, s in enumerate(kept)}
    return Automaton([{x: number[t] for x, t in step[s].items()} for s in kept], [counts[s] for s in kept], [ended[s] for s in kept])


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, begin, end and credential of what the plain patterns find."""
    found = [("assign", m.start(), m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= LEAST_LETTERS["assign"]]
    for kind, pattern in (("access", _ACCESS), ("hex", _HEX)):
        least = LEAST_LETTERS[kind]
        found += [(kind, m.start(), m.end(), m[0]) for m in pattern.finditer(text) if m.end() - m.start() >= least]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
_FOUND = "doc_id bigint, base {span}, candidates {span}".format(
    span="array<struct<kind: string, start: bigint, end: bigint, value: string>>")


def _find(letters: int):
    candidate = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % letters)
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(_SPAN)), ("candidates", pa.list_(_SPAN))])

    def rows(spans):
        return [{"kind": k, "start": a, "end": b, "value": v} for k, a, b, v in spans]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, candidates = [], []
            for raw in batch.column("text").to_pylist():
                text = (raw or b"").decode("utf-8", "replace")
                own = base_spans(text)
                base.append(rows(own))
                others, at, reach = [], 0, 0
                for m in candidate.finditer(text):
                    # Both lists go from left to right.
                    while at < len(own) and own[at][1] < m.end():
                        reach = max(reach, own[at][2])
                        at += 1
                    if reach <= m.start():
                        others.append((PLAIN, m.start(), m.end(), m[0]))
                candidates.append(rows(others))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(candidates, pa.list_(_SPAN))], schema=schema)

    return find


def sampled(strings: DataFrame, most: int, seed: int = 3) -> DataFrame:
    """At most ``most`` distinct values of each kind, those with the smallest hashes."""
    distinct = stored(strings.filter(F.length("value") > 0).select(
        "kind", "value", (F.xxhash64("value", F.lit(seed)) / F.lit(2.0**64) + 0.5).alias("at")).distinct(), "credentials")
    sizes = distinct.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    # First about twice as many as needed, so that the exact choice below has a bounded group.
    near = distinct.join(sizes, "kind").filter(F.col("at") * F.col("n") <= 2 * most + 100)
    pick = F.slice(F.array_sort(F.collect_list(F.struct("at", "value"))), 1, most)
    return near.groupBy("kind").agg(pick.alias("picked")).select("kind", F.explode("picked.value").alias("value"))


def learn(strings: DataFrame, *, sample: int = SAMPLE, longest: int = LONGEST, alpha: float = ALPHA) -> dict[str, Automaton]:
    """An automaton for each kind of ``strings`` (kind, value), from a bounded sample of the distinct values."""
    picked: dict[str, list[str]] = {}
    for r in sampled(strings.filter(F.length("value") <= longest), sample).collect():
        picked.setdefault(r.kind, []).append(r.value)
    return {kind: infer(values, alpha) for kind, values in sorted(picked.items())}


def _judge(automata: dict[str, Automaton], evidence: float):
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
        ("n_grammar", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("found", spans)])
    formats = [a for kind, a in automata.items() if kind != PLAIN]
    plain = automata.get(PLAIN)

    def joined(found) -> str:
        return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            rows = []
            if len(known) > 100_000:
                known.clear()
            for doc, base, candidates in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "base", "candidates"))):
                found = [(s["kind"], s["start"], s["end"], None) for s in base]
                counts = Counter(s[0] for s in found)
                digest = hashlib.sha256(joined(found).encode()).hexdigest()
                for c in candidates if formats and plain else ():
                    value = c["value"]
                    score = known.get(value)
                    if score is None:
                        score = known[value] = max(a.score(value) for a in formats) - plain.score(value)
                    if score >= evidence:
                        found.append(("grammar", c["start"], c["end"], score))
                found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                rows.append((
                    doc, counts["assign"], counts["access"], counts["hex"], len(found) - len(base), digest, joined(found),
                    [{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in found]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return judge


def scan(
    docs: DataFrame, *, labelled: DataFrame | None = None, letters: int = CANDIDATE_LETTERS, sample: int = SAMPLE,
    longest: int = LONGEST, alpha: float = ALPHA, evidence: float = EVIDENCE,
) -> DataFrame:
    """Spans of secrets in every whole text, in code points, ends exclusive.

    Plain patterns find assignments, access keys and long hexadecimal strings; these always stay. Their credentials, or the rows of
    ``labelled`` (kind, value), are the labelled samples: an automaton is inferred for each kind and one for plain strings, which are the
    other candidates of all documents (or the rows of kind ``plain``). A candidate is a whole stretch of ``letters`` or more letters, digits and ``+/_.=-`` that
    touches no span of the patterns. Every candidate is scored, and those likelier by ``evidence`` under a credential automaton
    than under the plain one are added as kind ``grammar``.

    ``doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256`` (of the patterns' spans as ``kind:start:end`` by start, then kind), ``spans``
    (all of them as text) and ``found`` (as an array, with scores of the added ones). Automata come from the
    ``sample`` distinct values of a kind with the smallest hashes, of ``longest`` letters at most; without
    values of a credential kind or plain ones nothing is added.

    Null and empty texts have no spans. Repeated rows and rows without doc_id are scanned each; bytes that are not UTF-8 count as
    one letter each; other columns are not read. An empty table gives no rows.
    """
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    found = stored(text_rows(docs, ids).mapInArrow(_find(letters), _FOUND), "secrets")
    if labelled is None:
        labelled = found.select(F.explode(F.concat("base", "candidates")).alias("s")).select("s.kind", "s.value")
    automata = learn(labelled.select("kind", "value"), sample=sample, longest=longest, alpha=alpha)
    return found.mapInArrow(
        _judge(automata, evidence),
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_grammar bigint, base_sha256 string, spans string, "
        "found array<struct<kind: string, start: bigint, end: bigint, score: double>>")
