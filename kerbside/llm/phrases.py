"""Phrase collocations by vertical partitioning of the suffix tree.

The corpus is cut into *blocks* of some 8 MB: a dictionary of the block's
words and a stream of their places in it, with marks where pieces end.  The
suffix tree of all streams, cut off at four words, is never built as a whole:

1. Words are counted; those below ``min_count`` can't be in a candidate, so
   a suffix ends before them.  The rest get dense ids in (lang, word) order.
2. *Vertical partitions*: the words, in that order and weighed by their
   occurrences, are cut into groups of ``BUDGET`` occurrences.  A prefix whose
   words so far all have more than that is extended by a word, up to four;
   these longer prefixes are dealt by hash over the groups of their first
   word.  A prefix occurs no more often than its rarest word, so each prefix
   fits the budget without a scan of its own, and so do a group's subtrees.
3. Blocks send each position's truncated suffix to its group, equal ones
   combined to one row with a count.
4. A group sorts its suffixes, which is its subtrees' depth-first order, and
   reads each node's count as the total of the leaves below it.  Nodes above
   an extended prefix are split over groups; only their totals are added up.

Scores, cuts and containment are joins over the nodes that are frequent.
Nothing is sampled or capped; ids are exact, as no word is hashed.

Defined results: a NULL text is empty; a NULL lang is ``und``; repeated rows
count as often as they stand; ties are broken by phrase in byte order; an
empty table gives no row; other columns aren't read, so their names don't
matter.  A long text is cut into blocks at piece ends; one piece (text
without any separator) must fit in a task.  Ids are below 2^31.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches, written

MIN_COUNT = 30
TOP = 2000
#: Bytes of text of one block.
BLOCK_BYTES = 8 << 20
#: Occurrences of one group of word prefixes (rows of its suffixes at most, but for equal ones of many tasks).
BUDGET = 1 << 19
#: Suffixes that a task combines before it sends them.
BUFFER_ROWS = 1 << 20
_OUT_ROWS = 1 << 16

# A-Z to a-z, tab to space, every separator of pieces to a line feed
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_LOW = 0xFFFFFFFF
_BLOCKS = "lang string, words array<string>, counts array<int>, stream binary"
_SUFFIXES = "g long, k1 long, k2 long, cnt long"


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        return k


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    langs: dict[str, tuple[_Ids, array]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (ids, stream) in langs.items():
            s = np.frombuffer(stream, np.int32)
            cnt = np.bincount(s[s >= 0], minlength=len(ids)).astype(np.int32)
            words = pa.array(list(ids), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), words),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(cnt, pa.int32())),
                 pa.array([s.tobytes()], pa.binary())], names=["lang", "words", "counts", "stream"])

    for b in batches:
        for text, lang in zip(b.column(0), b.column(1).to_pylist()):
            raw = text.as_py()
            if not raw:
                continue
            for piece in raw.encode().translate(_TABLE).split(b"\n"):
                words = piece.split()
                if not words:
                    continue
                if lang not in langs:
                    langs[lang] = (_Ids(), array("i"))
                ids, stream = langs[lang]
                stream.extend(map(ids.__getitem__, words))
                stream.append(-1)
                held += len(piece) + 1
                if held >= BLOCK_BYTES:
                    yield from flush()
                    langs, held = {}, 0
    yield from flush()


def _starts(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Where each run of equal pairs begins."""
    return np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))


def _combine(k1: np.ndarray, k2: np.ndarray, cnt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (k1, k2) with the sums of their counts."""
    o = np.lexsort((k2, k1))
    k1, k2, cnt = k1[o], k2[o], cnt[o]
    new = _starts(k1, k2)
    return k1[new], k2[new], np.add.reduceat(cnt, new)


def _suffixes(budget: int, buffer_rows: int):
    """Blocks with the frequent words' (place, id, start, f) to truncated suffixes by group.

    A suffix w1..w4 is two numbers, w1 << 32 | w2 and w3 << 32 | w4, with 0 for none.
    ``g`` is four times the group plus the length of the prefix less one."""

    def send(held: list) -> Iterator[pa.RecordBatch]:
        k1, k2, start, f, size = (np.concatenate(x) for x in zip(*held))
        o = np.lexsort((k2, k1))
        k1, k2, start, f, size = k1[o], k2[o], start[o], f[o], size[o]
        new = _starts(k1, k2)
        cnt = np.diff(np.append(new, len(k1)))
        k1, k2, start, f, size = k1[new], k2[new], start[new], f[new], size[new]
        third = np.where(size > 3, k2, np.where(size > 2, k2 >> 32, 0)).astype(np.uint64)
        x = (k1 & _LOW).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ third * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        within = ((x >> np.uint64(32)) % f.astype(np.uint64)).astype(np.int64)
        g = (start + np.where(size > 1, within, 0)) // budget * 4 + size - 1
        for i in range(0, len(g), _OUT_ROWS):
            j = slice(i, i + _OUT_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(a[j].astype(np.int64)) for a in (g, k1, k2, cnt)],
                                             names=["g", "k1", "k2", "cnt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            for i in range(b.num_rows):
                stream = np.frombuffer(b.column("stream")[i].as_py(), np.int32)
                found = b.column("found")[i].values
                place, wid, first, freq = (found.field(n).to_numpy(zero_copy_only=False) for n in ("loc", "id", "start", "f"))
                n = int(stream.max(initial=0)) + 2
                table, starts, freqs = (np.zeros(n, np.int64) for _ in range(3))
                table[place], starts[place], freqs[place] = wid, first, freq
                # the mark -1 reads the last, empty entry
                stream = np.concatenate([stream, np.full(3, -1, np.int32)])
                w, f = table[stream], freqs[stream]
                at = np.flatnonzero((w[:-3] > 0) & (w[1:-2] > 0))
                if not len(at):
                    continue
                w3 = w[at + 2]
                w4 = np.where(w3 > 0, w[at + 3], 0)
                # words up to the first that is within the budget
                size = np.select([f[at] <= budget, f[at + 1] <= budget, f[at + 2] <= budget], [1, 2, 3], 4)
                held.append((w[at] << 32 | w[at + 1], w3 << 32 | w4, starts[stream[at]], f[at], size))
                rows += len(at)
                if rows >= buffer_rows:
                    yield from send(held)
                    held, rows = [], 0
        if held:
            yield from send(held)

    return run


def _subtrees(least: int):
    """The nodes of two to four words of one group's subtrees with their leaf totals: those of
    ``least`` occurrences, and all that are split over groups."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        k1, k2, cnt = _combine(*(t.column(c).to_numpy() for c in ("k1", "k2", "cnt")))
        prefix = (key[0].as_py() & 3) + 1
        out = []
        for words, node, deep in ((2, k2 * 0, k2 >= 0), (3, k2 & ~_LOW, k2 > 0), (4, k2, (k2 & _LOW) > 0)):
            a, b, c = k1[deep], node[deep], cnt[deep]
            if len(a):
                new = _starts(a, b)
                a, b, c = a[new], b[new], np.add.reduceat(c, new)
                keep = (c >= least) | (words < prefix)
                out.append((a[keep], b[keep], c[keep]))
        k1, k2, cnt = (np.concatenate(x) for x in zip(*out))
        return pa.table({"k1": k1, "k2": k2, "cnt": cnt})

    return run


def vocabulary(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, word, f, id, start) of the frequent words: dense ids from 1 in (lang, word)
    order, ``start`` is the sum of the f before."""
    counted = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("z")) \
        .groupBy("lang", F.col("z.words").alias("word")).agg(F.sum("z.counts").alias("f")).where(F.col("f") >= least)
    ordered = written(counted.repartitionByRange("lang", "word").withColumn("part", F.spark_partition_id()), "phrase-words")
    parts = ordered.groupBy("part").agg(F.sum("f").alias("pf"), F.count("*").alias("pn"))
    # one row per partition of the table above
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("pf").over(before), F.lit(0)).alias("f0"),
                         F.coalesce(F.sum("pn").over(before), F.lit(0)).alias("n0"))
    w = Window.partitionBy("part").orderBy("lang", "word")
    inner = ordered.select("*", F.row_number().over(w).alias("r"),
                           F.coalesce(F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"))
    return written(inner.join(parts, "part").select("lang", "word", "f", (F.col("r") + F.col("n0")).alias("id"),
                                                    (F.col("s") + F.col("f0")).alias("start")), "phrase-vocabulary")


def nodes(blocks: DataFrame, vocab: DataFrame, least: int, budget: int = BUDGET, buffer_rows: int = BUFFER_ROWS) -> DataFrame:
    """(k1, k2, f) of every phrase of two to four words that occurs ``least`` times."""
    place = blocks.select("block", "lang", F.posexplode("words").alias("loc", "word"))
    found = place.join(vocab, ["lang", "word"]).groupBy("block") \
        .agg(F.collect_list(F.struct("loc", "id", "start", "f")).alias("found"))
    suffixes = blocks.select("block", "stream").join(found, "block").drop("block").mapInArrow(_suffixes(budget, buffer_rows), _SUFFIXES)
    counted = suffixes.groupBy("g").applyInArrow(_subtrees(least), "k1 long, k2 long, cnt long")
    return written(counted.groupBy("k1", "k2").agg(F.sum("cnt").alias("f")).where(F.col("f") >= least), "phrase-nodes")


def _key(words: list[Column]) -> Column:
    """Struct (k1, k2) of one to four word ids."""
    w = words + [F.lit(0).cast("long")] * (4 - len(words))
    return F.struct(F.shiftleft(w[0], 32).bitwiseOR(w[1]).alias("k1"), F.shiftleft(w[2], 32).bitwiseOR(w[3]).alias("k2"))


def _exact(c) -> Column:
    return (F.col(c) if isinstance(c, str) else F.lit(c)).cast("decimal(20,0)")


def scored(phrases: DataFrame, vocab: DataFrame) -> DataFrame:
    """Candidates that no longer one covers, with the lowest-scoring cut: (w, a, l, r, score)."""
    w = [F.shiftrightunsigned("k1", 32), F.col("k1").bitwiseAND(_LOW), F.shiftrightunsigned("k2", 32), F.col("k2").bitwiseAND(_LOW)]
    c = phrases.withColumnRenamed("f", "a").withColumn("w", F.filter(F.array(*w), lambda x: x > 0)).withColumn("d", F.size("w"))
    wi = [F.get("w", F.lit(i)) for i in range(4)]
    runs = {d: [(i, k) for k in range(2, d) for i in range(d - k + 1)] for d in (3, 4)}
    inside = F.when(F.col("d") == 3, F.array(*[_key(wi[i:i + k]) for i, k in runs[3]])) \
        .when(F.col("d") == 4, F.array(*[_key(wi[i:i + k]) for i, k in runs[4]]))
    longer = c.where(F.col("d") > 2).select("a", F.explode(inside).alias("s")) \
        .groupBy(F.col("s.k1").alias("k1"), F.col("s.k2").alias("k2")).agg(F.max("a").alias("cover"))
    kept = c.join(longer, ["k1", "k2"], "left") \
        .where(F.col("cover").isNull() | (_exact(100) * _exact("cover") < _exact(80) * _exact("a")))
    cut = [F.struct(F.lit(k).alias("k"), _key(wi[:k]).alias("left"), F.when(F.col("d") == d, _key(wi[k:d])).alias("right"))
           for d in (2, 3, 4) for k in range(1, d)]
    cuts = F.when(F.col("d") == 2, F.array(cut[0])).when(F.col("d") == 3, F.array(*cut[1:3])).otherwise(F.array(*cut[3:]))
    parts = phrases.select("k1", "k2", "f").unionByName(
        vocab.select(F.shiftleft("id", 32).alias("k1"), F.lit(0).cast("long").alias("k2"), "f"))

    def side(name: str, f: str) -> DataFrame:
        return parts.select(F.struct("k1", "k2").alias(name), F.col("f").alias(f))

    x = kept.select("w", "a", F.explode(cuts).alias("c")).select("w", "a", "c.*") \
        .join(side("left", "l"), "left").join(side("right", "r"), "right")
    score = F.expr("cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b")
    return x.groupBy("w", "a").agg(best).select("w", "a", "b.l", "b.r", "b.score")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", least: int = MIN_COUNT, top: int = TOP,
         budget: int = BUDGET) -> DataFrame:
    """The ``top`` collocations of each lang: lang, rank, phrase, a, l, r, n, score.

    ``a``, ``l`` and ``r`` are the occurrences of the phrase and of the two parts of
    its weakest cut, ``n`` those of all words of the lang."""
    small_batches(docs.sparkSession)
    lang = F.lit("und") if lang_col is None else F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    cut = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), lang.alias("lang")).mapInArrow(_blocks, _BLOCKS)
    blocks = written(cut.withColumn("block", F.monotonically_increasing_id()), "phrase-blocks")
    total = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, v: s + v)).alias("n"))
    vocab = vocabulary(blocks, least)
    s = written(scored(nodes(blocks, vocab, least, budget), vocab), "phrase-scores")
    first = vocab.select(F.col("id").alias("id0"), "lang")
    s = s.join(first, F.col("id0") == F.get("w", F.lit(0)))
    # ties of the last place stay until their phrases are known
    near = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    s = s.withColumn("near", F.rank().over(near)).where(F.col("near") <= top)
    spelt = s.select("*", F.posexplode("w").alias("i", "id")).join(vocab.select("id", "word"), "id") \
        .groupBy("lang", "w", "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("x")) \
        .withColumn("phrase", F.array_join("x.word", " "))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    spelt = spelt.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return spelt.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
