"""Toxicity by class-conditional Kneser-Ney models.

Texts are read as words of 32 symbols: the end of a word, a to z, and five
classes that all other letters and digits share (by code point, so accented
letters of one language mostly stay apart; scripts other than Latin are told
apart less well).  For each class, toxic and ordinary, an interpolated
Kneser-Ney model gives the next symbol of a word.  Its longest context is the
whole word so far (*stems*, six to eleven symbols, that toxic rows hold at
least twice), then the last four symbols, then three, counted by class.  Both
classes back off to the same orders 3 to 1, counted over all labelled texts:
an expression that the labelled rows hardly hold is weighed by counts that
both classes share, and one that only begins like known ones shows there.

A text's evidence is the log-likelihood ratio of the classes, per symbol of
the whole text, and of its most telling words.  A logistic regression turns it
into a score.  It is fitted on labelled rows that the models it sees were not
counted on (a third of the training rows); the models that score are counted
on all training rows, none left out.  What is collected and broadcast is bounded:
the 2^25 strings of five symbols (six bytes each that occurs, two each in a
worker), and about ``STEMS`` stems with their next symbols.  If toxic rows hold
more stems than that, the stems are dealt into parts by their first five
symbols, so that a word's stems lie in one part, and the texts are read once for
each part.  Which stems there are doesn't depend on it, and what a text's words
tell is added up over the parts.

Defined results: a NULL or empty text, or one without words, scores 0; repeated
rows get equal rows; a NULL doc_id is never held out and never labelled; of
contradicting labels of one id the toxic one counts, NULL labels are ignored;
without labels of both classes all texts with words score the share of toxic
labels (0 without labels).  doc_id must cast to long.  Other columns aren't read.
"""

from __future__ import annotations

import copy
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches, written

#: Score from which a text is called toxic.
THRESHOLD = 0.3
#: crc32(doc_id) mod 4 of the rows that no label is learnt from, and of those the regression is fitted on.
HELD_OUT, CALIBRATION = 2, 3
#: Bits of the filters that keep texts without a label and unknown stems out of the joins that decide.
LABEL_BITS = 1 << 26
#: Stems (words' beginnings of six to eleven symbols) of one part of the model, and the occurrences in toxic rows that make one.
STEMS, STEM_COUNT = 1 << 21, 2
#: Places of the most telling words that count by themselves, log ratios of a telling word, characters handled at a time.
PLACES, TELLING, TOLD, SLICE_CHARS = (1, 3, 5), 2.5, 1.5, 1 << 20
FEATURES = ("whole", "first", "third", "fifth", "size", "n_telling", "n_dense", "told")

_BITS, _ORDER = 5, 5
_CTX, _CELLS = 1 << _BITS * (_ORDER - 1), 1 << _BITS * _ORDER
_STEM = range(5, 12)
_SUMS, _SPREAD = 6, 2654435761
_TOKENS = "g long, toxic int, part int, n long"


def _symbols() -> np.ndarray:
    """Symbol of each code point below 0x250; 0 ends a word."""
    t = np.zeros(0x250, np.uint8)
    for c in range(0x250):
        low = chr(c).lower()[0]
        if "a" <= low <= "z":
            t[c] = ord(low) - 96
        elif low.isalnum():
            t[c] = 27 + ord(low) % 5
    return t


_TABLE = _symbols()


def encode(text: str) -> np.ndarray:
    """Symbols of a text."""
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    far = cp >= len(_TABLE)
    if not far.any():
        return _TABLE[cp]
    punctuation = ((cp >= 0x2000) & (cp < 0x2070)) | ((cp >= 0x3000) & (cp < 0x3040)) | ((cp >= 0xFE00) & (cp < 0x10000))
    return np.where(far, np.where(punctuation, 0, 27 + cp % 5), _TABLE[np.minimum(cp, len(_TABLE) - 1)]).astype(np.uint8)


def grams(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, five-symbol string) of every symbol of a word and of every end of a word;
    before its word stand zeros.  ``s`` must begin and end with 0."""
    g = s.astype(np.int32)
    before, shift = g, 0
    for k in range(1, _ORDER):
        shift += _BITS
        back = np.zeros_like(before)
        back[k:] = s[:-k]
        back[before == 0] = 0 if k > 1 else back[before == 0]
        g = g | back << shift
        before = back
    at = np.flatnonzero((s > 0) | np.concatenate([[False], s[:-1] > 0]))
    return at, g[at]


def _slices(texts: list) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(text numbers, where each begins, symbols with 0 around each text) of some texts at a time."""
    ids, parts, starts, n = [], [np.zeros(1, np.uint8)], [], 1
    for i, t in enumerate(texts):
        if t:
            s = encode(t)
            ids.append(i)
            starts.append(n)
            parts += [s, np.zeros(1, np.uint8)]
            n += len(s) + 1
        if ids and n > SLICE_CHARS:
            yield ids, np.array(starts), np.concatenate(parts)
            ids, parts, starts, n = [], [np.zeros(1, np.uint8)], [], 1
    if ids:
        yield ids, np.array(starts), np.concatenate(parts)


def stems(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the places ``at`` (see :func:`grams`): which have a stem before them, and stem and symbol
    as one number of five bits a symbol."""
    starts = np.flatnonzero((s[at] > 0) & (s[at - 1] == 0))
    run = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    deep = np.flatnonzero((run >= _STEM[0]) & (run <= _STEM[-1]))
    key, p, k = np.zeros(len(deep), np.int64), at[deep], run[deep]
    for back in range(_STEM[-1] + 1):
        key |= np.where(back <= k, s[np.maximum(p - back, 0)], 0).astype(np.int64) << _BITS * back
    return deep, key


class Keys:
    """Sorted numbers, asked for many at a time."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self._bit(self.keys)] = True

    @staticmethod
    def _bit(k: np.ndarray) -> np.ndarray:
        return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def find(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``k`` are here, and their places."""
        maybe = np.flatnonzero(self.bits[self._bit(k)]) if len(self.keys) else np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.keys, k[maybe]), len(self.keys) - 1)
        hit = self.keys[place] == k[maybe] if len(maybe) else np.zeros(0, bool)
        return maybe[hit], place[hit]


def _count(read):
    """Counts of strings by label and part (1: the rows that calibrate), combined by task;
    ``read`` gives (places, strings) of symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for b in batches:
            label, part = b.column("toxic").to_numpy(), b.column("part").to_numpy()
            for ids, starts, s in _slices(b.column("text").to_pylist()):
                at, g = read(s)
                doc = np.array(ids)[np.searchsorted(starts, at, "right") - 1]
                kind = label[doc] * 2 + part[doc]
                for k in np.unique(kind):
                    total.setdefault(int(k), []).append(np.unique(g[kind == k], return_counts=True))
            for k, held in total.items():
                if len(held) > 16:
                    total[k] = [_sums(held)]
        for k, held in total.items():
            g, n = _sums(held)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(np.full(len(g), k // 2, np.int32)),
                                              pa.array(np.full(len(g), k % 2, np.int32)), pa.array(n, pa.int64())],
                                             names=["g", "toxic", "part", "n"])

    return run


def _read_stems(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stems alone, as strings that end in 0."""
    at, _ = grams(s)
    deep, key = stems(s, at)
    return at[deep], key >> _BITS


def _read_known(bits):
    """Stems with a symbol, those that pass the filter of the known stems."""
    def run(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, _ = grams(s)
        deep, key = stems(s, at)
        bit = _stem_bit(key >> _BITS)
        hit = np.flatnonzero(bits.value[bit >> 3] & (128 >> (bit & 7)).astype(np.uint8))
        return at[deep[hit]], key[hit]
    return run


def _stem_bit(stem: np.ndarray) -> np.ndarray:
    return ((stem.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 26)).astype(np.int64)


def _stem_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_stem_bit(b.column("g").to_numpy()).astype(np.int32))], names=["bit"])


def _filter(bits: DataFrame) -> np.ndarray:
    """A string of ``LABEL_BITS`` bits, those of the column ``bit`` set."""
    cells = bits.distinct().select(F.expr("cast(bit div 8 as int)").alias("cell"), (F.col("bit") % 8).alias("place")) \
        .groupBy("cell").agg(F.sum(F.expr("shiftright(128, place)")).cast("int").alias("bits")).toArrow()
    out = np.zeros(LABEL_BITS // 8, np.uint8)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return out


def _sums(held: list) -> tuple[np.ndarray, np.ndarray]:
    g, inverse = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    return g, np.bincount(inverse, np.concatenate([h[1] for h in held])).astype(np.int64)


# ---------------------------------------------------------------- the models

def _discount(c: np.ndarray) -> float:
    n1, n2 = float((c == 1).sum()), float((c == 2).sum())
    return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5


def _lower(c: np.ndarray) -> np.ndarray:
    """Counts of the next lower order: the distinct symbols before a string, or the
    occurrences of one that begins where its word does (only zeros stand before it)."""
    rows = c.reshape(1 << _BITS, -1)
    low = (rows > 0).sum(0).astype(np.float64)
    own = len(low) >> _BITS
    low[:own] = rows[:, :own].sum(0)
    return low


def _interpolate(c: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Kneser-Ney probabilities of all strings of one order from its counts and the
    probabilities of the next lower order; an unseen context takes the lower order's."""
    d = _discount(c)
    rows = c.reshape(-1, 1 << _BITS)
    total, types = rows.sum(1, keepdims=True), (rows > 0).sum(1, keepdims=True)
    rest = np.where(total > 0, d * types / np.maximum(total, 1), 1.0)
    below = np.broadcast_to(lower.reshape(1, -1), (1 << _BITS, lower.size)).reshape(-1, 1 << _BITS) if lower.size > 1 \
        else np.full((len(rows), 1 << _BITS), 1 / (1 << _BITS))
    return (np.maximum(rows - d, 0) / np.maximum(total, 1) + rest * below).ravel()


def fourth_order(toxic: np.ndarray, ordinary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order-4 probabilities by class, over shared orders 3 to 1."""
    c3 = _lower(toxic + ordinary)
    c2 = _lower(c3)
    c1 = _lower(c2)
    p = np.ones(1)
    for c in (c1, c2, c3):
        p = _interpolate(c, p)
    return _interpolate(toxic, p), _interpolate(ordinary, p)


class Counts:
    """Totals and kinds of both classes by the four symbols before the last (context) and the last
    four (suffix) of five-symbol strings, and the classes' discounts.  At most 2^20 of each; sent as
    those that occur, opened as the tables of a worker."""

    def __init__(self, contexts: dict, suffixes: dict, d: tuple[float, float]):
        self.contexts, self.suffixes, self.d = contexts, suffixes, d

    def open(self) -> "Counts":
        def full(t: dict, c: str) -> np.ndarray:
            a = np.zeros(_CTX)
            a[t["key"]] = t[c]
            return a

        own = np.arange(_CTX) < _CTX >> _BITS
        self.p4 = fourth_order(*[np.where(own, full(self.suffixes, c + "all"), full(self.suffixes, c + "kinds")) for c in "to"])
        self.total = [full(self.contexts, c + "all") for c in "to"]
        self.rest = [np.where(t > 0, x * full(self.contexts, c + "kinds") / np.maximum(t, 1), 1.0)
                     for t, c, x in zip(self.total, "to", self.d)]
        return self

    def fifth(self, g: np.ndarray, counts: tuple) -> list[np.ndarray]:
        """Order-5 probabilities by class of strings with these counts."""
        return [np.maximum(c - self.d[k], 0) / np.maximum(self.total[k][g >> _BITS], 1)
                + self.rest[k][g >> _BITS] * self.p4[k][g & (_CTX - 1)] for k, c in enumerate(counts)]


class Model:
    """Log-likelihood ratios: of the five-symbol strings seen (others from the counts), of stems (``stem``,
    what an unseen symbol after it adds) and of stems with a seen symbol (``grown``)."""

    def __init__(self, counts: Counts, seen, ratio, stem, stem_ratio, grown, grown_ratio):
        self.counts, self.seen, self.ratio = counts, seen, ratio
        self.stem, self.stem_ratio, self.grown, self.grown_ratio = stem, stem_ratio, grown, grown_ratio

    def open(self) -> "Model":
        """Fill the tables of a worker."""
        c, out = copy.copy(self.counts).open(), copy.copy(self)
        table = np.empty((1 << _BITS, _CTX >> _BITS, 1 << _BITS), np.float16)
        ctx = np.log(c.rest[0] / c.rest[1]).reshape(1 << _BITS, -1, 1)
        suffix = np.log(c.p4[0] / c.p4[1]).reshape(-1, 1 << _BITS)
        for first in range(1 << _BITS):
            table[first] = ctx[first] + suffix
        out.table = table.ravel()
        out.table[self.seen] = self.ratio
        out.stems, out.growns = Keys(self.stem), Keys(self.grown)
        return out

    def ratios(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, log ratio) of the symbols and ends of words."""
        at, g = grams(s)
        r = self.table[g].astype(np.float64)
        deep, key = stems(s, at)
        known, place = self.stems.find(key >> _BITS)
        deep, key = deep[known], key[known]
        r[deep] += self.stem_ratio[place]
        hit, place = self.growns.find(key)
        r[deep[hit]] = self.grown_ratio[place]
        return at, r


_OPEN: dict = {}


def _opened(shared):
    """The opened tables of a broadcast; a worker keeps one."""
    key = shared.value.key
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = copy.copy(shared.value).open()
    return _OPEN[key]


def _share(spark, tables):
    tables.key = uuid.uuid4().hex
    return spark.sparkContext.broadcast(tables)


def _seen(tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = b.column("g").to_numpy()
            p = _opened(tables).fifth(g, tuple(b.column(c).to_numpy() for c in ("t", "o")))
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(np.log(p[0] / p[1]).astype(np.float32))], names=["g", "ratio"])
    return run


def _grown(tables, d: tuple[float, float]):
    """Stems with a symbol: the counts of both (t, o and the stem's totals and kinds), of the last five symbols (t5, o5)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("g").to_numpy()
            n = {c: b.column(c).to_numpy().astype(np.float64) for c in b.schema.names if c != "g"}
            below = _opened(tables).fifth(key & (_CELLS - 1), (n["t5"], n["o5"]))
            p = [np.where(n[c + "all"] > 0, (np.maximum(n[c] - d[k], 0) + d[k] * n[c + "kinds"] * below[k])
                          / np.maximum(n[c + "all"], 1), below[k]) for k, c in enumerate(("t", "o"))]
            yield pa.RecordBatch.from_arrays([b.column("g"), pa.array(np.log(p[0] / p[1]).astype(np.float32))], names=["g", "ratio"])

    return run


def _once_twice(counts: DataFrame) -> tuple[float, float]:
    """Discounts of both classes from the strings seen once and twice."""
    r = counts.agg(*[F.sum((F.col(c) == v).cast("double")).alias(f"{c}{v}") for c in "to" for v in (1, 2)]).first()
    one, two = ([r[f"{c}{v}"] or 0.0 for c in "to"] for v in (1, 2))
    return tuple(min(0.95, max(0.1, a / (a + 2 * b))) if a else 0.5 for a, b in zip(one, two))


def fit(counts: DataFrame, grown: DataFrame, parts: int = 1) -> Iterator[Model]:
    """The model of counts (g, t, o) of five-symbol strings and of stems with a symbol: t in toxic, o in ordinary texts;
    its parts by stem one after the other."""
    spark = counts.sparkSession

    def by(key: Column) -> dict:
        t = counts.groupBy(key.alias("key")).agg(*[F.sum(F.col(c)).alias(c + "all") for c in "to"],
                                                 *[F.sum((F.col(c) > 0).cast("long")).alias(c + "kinds") for c in "to"]).toArrow()
        return {c: t.column(c).to_numpy().astype(np.int32 if c == "key" else np.float64) for c in t.column_names}

    tables = _share(spark, Counts(by(F.shiftright("g", _BITS)), by(F.col("g").bitwiseAND(_CTX - 1)), _once_twice(counts)))
    seen = counts.mapInArrow(_seen(tables), "g long, ratio float").toArrow()

    dg = _once_twice(grown)
    whole = grown.groupBy(F.shiftright("g", _BITS).alias("stem")).agg(
        *[F.sum(c).alias(c + "all") for c in "to"], *[F.sum((F.col(c) > 0).cast("long")).alias(c + "kinds") for c in "to"])

    def left(c: str, k: int) -> Column:
        return F.when(F.col(c + "all") > 0, F.lit(dg[k]) * F.col(c + "kinds") / F.col(c + "all")).otherwise(1.0)

    stem = whole.select("stem", F.log(left("t", 0) / left("o", 1)).cast("float").alias("ratio"))
    fifth = counts.select(F.col("g").alias("last"), F.col("t").alias("t5"), F.col("o").alias("o5"))
    full = grown.withColumn("stem", F.shiftright("g", _BITS)).join(whole, "stem") \
        .withColumn("last", F.col("g").bitwiseAND(_CELLS - 1)).join(fifth, "last", "left").fillna(0, ["t5", "o5"]) \
        .select("g", "t", "o", "tall", "oall", "tkinds", "okinds", "t5", "o5")
    ratio = full.mapInArrow(_grown(tables, dg), "g long, ratio float")
    if parts > 1:  # read once for each part
        stem, ratio = written(stem, "toxicity-stem-ratios"), written(ratio, "toxicity-grown-ratios")
    for part in range(parts):
        a, b = stem, ratio
        if parts > 1:
            a, b = a.where(stem_part(F.col("stem"), parts) == part), b.where(stem_part(F.shiftright("g", _BITS), parts) == part)
        a, b = a.orderBy("stem").toArrow(), b.orderBy("g").toArrow()
        yield Model(Counts(tables.value.contexts, tables.value.suffixes, tables.value.d),
                    seen.column("g").to_numpy().astype(np.int32), seen.column("ratio").to_numpy().astype(np.float16),
                    a.column("stem").to_numpy(), a.column("ratio").to_numpy(), b.column("g").to_numpy(), b.column("ratio").to_numpy())


def word_part(s: np.ndarray, first: np.ndarray, parts: int) -> np.ndarray:
    """Part of the model that holds the stems of the words that begin at ``first``: by their first five symbols."""
    code, inside = np.zeros(len(first), np.int64), np.ones(len(first), bool)
    for k in range(_STEM[0]):
        now = s[np.minimum(first + k, len(s) - 1)].astype(np.int64)
        inside &= now > 0
        code = code << _BITS | np.where(inside, now, 0)
    return ((code * _SPREAD) % (1 << 32) >> 12) % parts


def stem_part(stem: Column, parts: int) -> Column:
    """Part of a stem (see :func:`word_part`)."""
    code = F.coalesce(*[F.when(stem < F.lit(1 << _BITS * k), F.shiftright(stem, _BITS * (k - _STEM[0]))) for k in _STEM])
    return F.shiftright((code * F.lit(_SPREAD)) % F.lit(1 << 32), 12) % F.lit(parts)


def states(model: Model, texts: list, part: int = 0, parts: int = 1) -> np.ndarray:
    """What the words of one part of the model tell of each text: sum and symbols of all, words, telling words,
    dense ones, what the telling ones tell, and the most telling ones."""
    out = np.zeros((len(texts), _SUMS + PLACES[-1]))
    out[:, _SUMS:] = -np.inf
    for ids, starts, s in _slices(texts):
        at, r = model.ratios(s)
        if not len(at):
            continue
        first = np.flatnonzero((s[at] > 0) & (s[at - 1] == 0))  # a word's first symbol; its end is the last before the next
        size = np.diff(np.append(first, len(at)))
        word = np.add.reduceat(r, first)
        doc = np.searchsorted(starts, at[first], "right") - 1
        if parts > 1:
            mine = word_part(s, at[first], parts) == part
            size, word, doc = size[mine], word[mine], doc[mine]
            if not len(doc):
                continue
        has, begin, words = np.unique(doc, return_index=True, return_counts=True)
        rows = np.array(ids)[has]
        per = word / np.sqrt(size)
        for k, v in enumerate((word, size, np.ones(len(word)), word > TELLING, per > 1, np.maximum(word - TOLD, 0))):
            out[rows, k] = np.add.reduceat(v, begin, dtype=np.float64)
        best = np.lexsort((-per, doc))
        for k in range(PLACES[-1]):
            some = words > k
            out[rows[some], _SUMS + k] = per[best[begin[some] + k]]
    return out


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The state of both parts' words."""
    best = -np.sort(-np.concatenate([a[:, _SUMS:], b[:, _SUMS:]], axis=1), axis=1)
    return np.concatenate([a[:, :_SUMS] + b[:, :_SUMS], best[:, : PLACES[-1]]], axis=1)


def features(state: np.ndarray) -> np.ndarray:
    """Evidence per text (one row each, see FEATURES; NaN without words)."""
    out = np.full((len(state), len(FEATURES)), np.nan)
    rows = np.flatnonzero(state[:, 2] > 0)
    total, size, words, telling, dense, told = state[rows, :_SUMS].T
    out[rows, 0] = total / size
    for k, place in enumerate(PLACES):
        out[rows, 1 + k] = state[rows, _SUMS + np.minimum(words, place).astype(np.int64) - 1]
    out[rows, 4] = np.log1p(words)
    out[rows, 5] = np.log1p(telling)
    out[rows, 6] = np.log1p(dense)
    out[rows, 7] = np.sqrt(told)
    return out


def _evidence(model, part: int, parts: int):
    def lists(x: np.ndarray) -> pa.Array:
        return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            state = states(_opened(model), b.column("text").to_pylist(), part, parts)
            keep = [c for c in b.schema.names if c not in ("state", "text")]
            held = [b.column(c) for c in keep]
            if part:
                state = joined(np.array(b.column("state").to_pylist(), np.float64).reshape(state.shape), state)
            if part < parts - 1:
                yield pa.RecordBatch.from_arrays([*held, lists(state), b.column("text")], names=[*keep, "state", "text"])
            else:
                f = features(state)
                yield pa.RecordBatch.from_arrays([*held, pa.array(~np.isnan(f[:, 0])), lists(np.nan_to_num(f))],
                                                 names=[*keep, "worded", "evidence"])

    return run


def evidence(df: DataFrame, models: Iterator[Model], parts: int) -> DataFrame:
    """``df``, whose last column is ``text``, with (worded, evidence) in its place.  The parts of the model are
    read one after the other, and the texts stored with what they told in between."""
    keep = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1])
    for part, model in enumerate(models):
        schema = f"{keep}, worded boolean, evidence array<double>" if part == parts - 1 else f"{keep}, state array<double>, text string"
        df = df.mapInArrow(_evidence(_share(df.sparkSession, model), part, parts), schema)
        if part < parts - 1:
            df = written(df, "toxicity-state")
    return df


def _bit(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(LABEL_BITS)).cast("int")


def _maybe_labelled(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits.value)
        for b in batches:
            yield b.filter(pa.array(known[b.column("bit").to_numpy()].astype(bool))).select(["id", "text"])
    return run


def training(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(toxic, part, text) of the texts (id, text) whose id is in ``known`` (id, toxic), stored.

    Only texts that pass a filter of fixed size (a bit per hashed id; passing means nothing by itself) are
    shuffled for the join; the join decides."""
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(_filter(known.select(_bit("id").alias("bit"))))
    near = docs.select("id", _bit("id").alias("bit"), "text").mapInArrow(_maybe_labelled(shared), f"id {kind}, text string")
    return written(near.join(known, "id").select("toxic", (remainder("id") == CALIBRATION).cast("int").alias("part"), "text"), "toxicity-training")


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % 4


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("text")
    known = labels.select(ident.alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where("toxic in (0, 1)") \
        .where(remainder("id") != HELD_OUT).groupBy("id").agg(F.max("toxic").alias("toxic"))
    train = training(docs.select(ident.alias("id"), text), known)
    rows = {(r["toxic"], r["part"]): r["n"] for r in train.groupBy("toxic", "part").agg(F.count("*").alias("n")).collect()}
    toxic, ordinary = (sum(rows.get((k, p), 0) for p in (0, 1)) for k in (1, 0))
    out = docs.select(ident.cast("long").alias(id_col), F.coalesce(remainder(id_col) == HELD_OUT, F.lit(False)).alias("held_out"), text)
    if not toxic or not ordinary:
        return out.select(id_col, "held_out", F.when(F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)), toxic / max(1, toxic + ordinary)).otherwise(0.0).alias("score")) \
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

    def total(*keys: tuple[int, int]) -> Column:
        hit = F.lit(False)
        for k, p in keys:
            hit = hit | ((F.col("toxic") == k) & (F.col("part") == p))
        return F.sum(F.when(hit, F.col("n")).otherwise(0))

    sums = (total((1, 0)).alias("t0"), total((0, 0)).alias("o0"),
            total((1, 0), (1, 1)).alias("t"), total((0, 0), (0, 1)).alias("o"))
    counts = written(train.mapInArrow(_count(lambda s: grams(s)), _TOKENS).groupBy("g").agg(*sums), "toxicity-counts")
    held = written(train.where("toxic = 1").mapInArrow(_count(_read_stems), _TOKENS).groupBy("g").agg(F.sum("n").alias("n"))
                   .where(F.col("n") >= STEM_COUNT), "toxicity-stems")
    parts = max(1, -(-held.count() // STEMS))
    near = spark.sparkContext.broadcast(_filter(held.select("g").mapInArrow(_stem_bits, "bit int")))
    grown = train.mapInArrow(_count(_read_known(near)), _TOKENS).groupBy("g").agg(*sums).withColumn("stem", F.shiftright("g", _BITS)) \
        .join(held.select(F.col("g").alias("stem")), "stem", "left_semi").drop("stem")
    grown = written(grown, "toxicity-grown")
    inside = grown.groupBy(F.shiftright("g", _BITS).alias("stem")).agg(F.sum("t0").alias("n")).where(F.col("n") >= STEM_COUNT)
    apart = all(rows.get((k, p)) for k in (0, 1) for p in (0, 1))
    half = [x.select("g", F.col("t0").alias("t"), F.col("o0").alias("o")).where("t + o > 0") for x in
            (counts, grown.withColumn("stem", F.shiftright("g", _BITS)).join(inside.select("stem"), "stem", "left_semi"))]
    whole = counts.select("g", "t", "o"), grown.select("g", "t", "o")
    seen = written(evidence(train.where("part = 1") if apart else train, fit(*(half if apart else whole), parts), parts), "toxicity-calibration")
    reg = LogisticRegression(maxIter=100, regParam=1e-4).fit(
        seen.where("worded").select(F.col("toxic").cast("double").alias("label"), array_to_vector("evidence").alias("features")))
    z = F.lit(float(reg.intercept))
    for i, w in enumerate(reg.coefficients):
        z = z + F.lit(float(w)) * F.get("evidence", F.lit(i))
    return evidence(out, fit(*whole, parts), parts).select(id_col, "held_out", F.when(F.col("worded"), 1 / (1 + F.exp(-z))).otherwise(0.0).alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
