"""Secrets by pattern and by inferred grammar.

Three patterns give the base spans (assignments, access keys, long hex
runs).  Their values are labelled credentials: per kind, a probabilistic
automaton is inferred from the prefix tree of (a bounded sample of) them by
merging states whose symbol frequencies don't differ by the Hoeffding bound,
and so is one for the background, from other runs.  Every remaining
candidate of the corpus is scored, whole runs and their parts
(:func:`candidates`): it is added as ``grammar`` when some kind's automaton
gives it a likelihood, its end included, as good as that kind's own values
have and clearly better than the background's.  One labelled value makes a
kind; any length can be accepted.

The texts are read once; spans and candidates are stored, the sample comes
from the store, and the scoring reads only the candidates.

Defined results: a NULL text is empty; repeated rows get equal results; with
no base spans in the corpus there is no grammar and nothing is added; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches, written

#: Kinds in the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "grammar")
#: Labelled credentials of each kind, and background runs, that the automata are inferred from.
SAMPLE = 1000
#: Significance of the merge test, least likelihood gain (nats) over the background,
#: share of a kind's own values that may score below its threshold.
ALPHA, GAIN, TAIL = 0.05, 6.0, 0.02

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
_PART, _FINE = re.compile(r"[^=/]{8,}"), re.compile(r"[^=/.]{8,}")


# ---------------------------------------------------------------- spans of one text

def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, kind number, end, value): the pattern matches, in listing order."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list) -> list[tuple[int, int, str]]:
    """(start, end, value) in order, a whole before its parts: what runs of credential
    characters have outside base spans, what stands there after the first ``=``, and their
    parts between ``=`` and ``/``, and between these and ``.``; each of 8 characters or more."""
    reach = list(accumulate((b[2] for b in base), max))  # furthest end of the spans up to each
    starts = [b[0] for b in base]
    out = []
    for m in _RUN.finditer(text):
        at, end = m.span()
        pieces = [(at, end)]
        k = bisect_left(starts, end)
        if k and reach[k - 1] > at:
            pieces, j = [], bisect_right(reach, at)  # the first span that ends in the run
            for b in base[j:k]:
                pieces.append((at, b[0]))
                at = max(at, b[2])
            pieces.append((at, end))
        for s, e in pieces:
            if e - s < 8:
                continue
            run = text[s:e]
            if "=" not in run and "/" not in run and "." not in run:
                out.append((s, e, run))
                continue
            found = {(s, e), (s + run.find("=") + 1, e)}
            for part in _PART.finditer(run):
                x = part[0]
                found.add((s + part.start() + len(x) - len(x.lstrip(".")), s + part.start() + len(x.rstrip("."))))
            found.update((s + part.start(), s + part.end()) for part in _FINE.finditer(run))
            out += [(a, b, text[a:b]) for a, b in sorted(found, key=lambda x: (x[0], -x[1])) if b - a >= 8]
    return out


# ---------------------------------------------------------------- grammar inference

def symbols(value: str) -> str:
    """Character classes: digits, a-f, other small letters, capitals; signs stand for themselves."""
    return value.translate(_CLASSES)


_CLASSES = {**{ord(c): "0" for c in "0123456789"}, **{ord(c): "a" for c in "abcdef"},
            **{ord(c): "g" for c in "ghijklmnopqrstuvwxyz"}, **{ord(c): "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}}
_END = "$"
_ALPHABET = 11


class Automaton:
    """Probabilistic automaton: counts of next symbols (and ends) by state."""

    def __init__(self, counts: dict[int, dict[str, int]], to: dict[int, dict[str, int]]):
        self.counts, self.to = counts, to
        self.total = {s: sum(c.values()) for s, c in counts.items()}

    def log_likelihood(self, word: str) -> float:
        s, out = 0, 0.0
        for x in [*word, _END]:
            n = self.counts[s].get(x, 0) if s is not None else 0
            total = self.total[s] if s is not None else 0
            out += math.log((n + 0.05) / (total + 0.05 * _ALPHABET))
            s = self.to[s].get(x) if s is not None and x != _END else None
        return out


def infer(words: list[str], alpha: float = ALPHA) -> Automaton:
    """Merge compatible states of the prefix tree of ``words``, nearest to the
    root first: red states are settled, blue ones are their children."""
    counts: dict[int, dict[str, int]] = {0: {}}
    to: dict[int, dict[str, int]] = {0: {}}
    for w in words:
        s = 0
        for x in w:
            counts[s][x] = counts[s].get(x, 0) + 1
            if x not in to[s]:
                to[s][x] = len(counts)
                counts[len(counts)] = {}
                to[len(to)] = {}
            s = to[s][x]
        counts[s][_END] = counts[s].get(_END, 0) + 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def alike(p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n, m = sum(counts[p].values()), sum(counts[q].values())
            if n and m:
                limit = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
                for x in counts[p].keys() | counts[q].keys():
                    if abs(counts[p].get(x, 0) / n - counts[q].get(x, 0) / m) > limit:
                        return False
            todo += [(to[p][x], to[q][x]) for x in to[p].keys() & to[q].keys() if to[p][x] != to[q][x]]
        return True

    def fold(p: int, q: int) -> None:
        """Add the tree at q to the state p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            for x, n in counts[q].items():
                counts[p][x] = counts[p].get(x, 0) + n
            for x, t in to[q].items():
                if x in to[p]:
                    todo.append((to[p][x], t))
                else:
                    to[p][x] = t
            del counts[q], to[q]

    red = [0]
    while True:
        settled = set(red)
        blue = sorted({(t, s, x) for s in red for x, t in to[s].items() if t not in settled})
        if not blue:
            return Automaton(counts, to)
        q, parent, x = blue[0]
        for p in red:
            if alike(p, q):
                to[parent][x] = p
                fold(p, q)
                break
        else:
            red.append(q)


class Grammar:
    """The automata of the kinds and of the background, with thresholds."""

    def __init__(self, values: dict[str, list[str]], background: list[str]):
        self.kinds = []
        for kind in sorted(values):
            words = [symbols(v) for v in values[kind]]
            if words:
                a = infer(words)
                each = sorted(a.log_likelihood(w) / (len(w) + 1) for w in words)
                self.kinds.append((a, each[int(TAIL * len(each))]))
        self.background = infer([symbols(v) for v in background])

    def accepts(self, value: str) -> bool:
        w = symbols(value)
        base = None
        for a, least in self.kinds:
            p = a.log_likelihood(w)
            if p / (len(w) + 1) >= least:
                base = self.background.log_likelihood(w) if base is None else base
                if p - base >= GAIN:
                    return True
        return False


# ---------------------------------------------------------------- Spark jobs

_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
_FOUND = "doc_id long, base array<struct<start int, kind int, end int, value string>>, " \
         "rest array<struct<start int, kind int, end int, value string>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        base, rest = [], []
        for text in b.column(1).to_pylist():
            found = base_spans(text or "")
            base.append([{"start": s, "kind": k, "end": e, "value": v} for s, k, e, v in found])
            rest.append([{"start": s, "kind": 3, "end": e, "value": v} for s, e, v in candidates(text or "", found)])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, _SPAN), pa.array(rest, _SPAN)],
                                         names=["doc_id", "base", "rest"])


def found_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, rest): stored base spans and candidates of every text."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return written(d.mapInArrow(_find, _FOUND), "secret-spans")


def _sampled(spans: DataFrame, column: str, kind: int, most: int) -> list[str]:
    """Up to ``most`` distinct values: those with the least hashes."""
    v = spans.select(F.explode(column).alias("x")).where(F.col("x.kind") == kind).select("x.value").distinct()
    return sorted(r["value"] for r in v.orderBy(F.xxhash64("value"), "value").limit(most).collect())


def learn(spans: DataFrame, sample: int = SAMPLE) -> Grammar | None:
    """The grammar of the stored spans, from at most ``sample`` values of each
    kind and as many background runs; None if the corpus has no labelled value."""
    values = {KINDS[k]: _sampled(spans, "base", k, sample) for k in range(3)}
    g = Grammar(values, _sampled(spans, "rest", 3, sample))
    return g if g.kinds else None


def _score(grammar: Grammar | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for base, rest in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                spans = [(x["start"], x["kind"], x["end"]) for x in base]
                done = 0  # parts of an accepted candidate are not listed again
                for x in rest if grammar else ():
                    if x["end"] <= done:
                        continue
                    if len(known) > 100_000:
                        known.clear()
                    w = symbols(x["value"])
                    if w not in known:
                        known[w] = grammar.accepts(x["value"])
                    if known[w]:
                        spans.append((x["start"], 3, x["end"]))
                        done = x["end"]
                text = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
                n = np.bincount([k for _, k, _ in spans] or [0], minlength=4) if spans else np.zeros(4, int)
                for c, v in zip(cols, (*n.tolist(), hashlib.sha256(",".join(text[:len(base)]).encode()).hexdigest(),
                                       ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)))):
                    c.append(v)
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "n_grammar", "base_sha256",
                                                    "spans"])
    return run


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256
    (of the base spans) and spans (all), each ``kind:start:end``."""
    spans = found_spans(docs, doc_id, text)
    return spans.mapInArrow(_score(learn(spans, sample)),
                            "doc_id long, n_assign long, n_access long, n_hex long, n_grammar long, base_sha256 string, "
                            "spans string")
