"""Best-fit-decreasing packing of token sequences.

Texts are encoded once, in the tasks that read them, cut into pieces of at
most ``capacity`` tokens and stored with their ids.  Piece lengths are small
integers, so what best-fit decreasing needs to know of a corpus of any size
is how many pieces there are of each length: at most ``capacity`` numbers,
gathered by one aggregation.  The plan is made from them with a segment tree
over remaining capacities that finds the tightest open bin in logarithmic
time; equal pieces going into equally full bins are placed as one run, so
the plan has few rows whatever the corpus size.  Each piece then learns its
place from its rank among the pieces of its length (counts per task and
length, summed over tasks by a window per length).

Defined results: a NULL or empty text is the end id alone; repeated rows and
rows with equal or NULL ids are pieces of their own; an empty table packs
into no sequence; only texts of more than ``capacity`` tokens are cut; extra
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches, written
from kerbside.llm.tokens import default_path, encoder

CAPACITY = 4096
END_ID = 1

_PIECES = "doc_id long, task int, row long, piece int, start long, length long, ids binary"


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, row = encoder(path), TaskContext.get().partitionId(), 0
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            flat, off = enc.encode(b.column(1).to_pylist())
            for i, d in enumerate(b.column(0).to_pylist()):
                ids = np.append(flat[off[i]: off[i + 1]], np.uint16(end_id)).astype("<u4")
                for p, s in enumerate(range(0, len(ids), capacity)):
                    part = ids[s: s + capacity]
                    for c, v in zip(cols, (d, task, row, p, s, len(part), part.tobytes())):
                        c.append(v)
                row += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "task", "row", "piece", "start", "length", "ids"])
    return run


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, task, row, piece, start, length, ids): ids of each piece as
    little-endian 32-bit integers; (task, row) tells input rows apart."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return written(d.mapInArrow(_pieces(path or default_path(), capacity, end_id), _PIECES), "pieces")


class OpenBins:
    """Open bins by remaining capacity.  A segment tree over the capacities
    0..n holds which of them have bins: :meth:`tightest` finds the least one
    that is large enough in O(log n).  Bins of one capacity are runs of
    consecutive numbers with one fill order."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.some = np.zeros(2 * self.size, bool)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def add(self, left: int, first: int, count: int) -> None:
        self.runs[left].append((first, count))
        k = left + self.size
        while k and not self.some[k]:
            self.some[k] = True
            k >>= 1

    def take(self, left: int, most: int) -> tuple[int, int]:
        """Remove up to ``most`` bins of one run with this remaining capacity."""
        first, count = self.runs[left].pop()
        if count > most:
            self.runs[left].append((first + most, count - most))
        elif not self.runs[left]:
            k = left + self.size
            self.some[k] = False
            while k > 1 and not self.some[k ^ 1]:
                k >>= 1
                self.some[k] = False
        return first, min(count, most)

    def tightest(self, need: int) -> int:
        """Least remaining capacity of at least ``need`` with an open bin, or -1."""
        k = need + self.size
        if self.some[k]:
            return need
        while k > 1:
            if not k & 1 and self.some[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.some[2 * k] else 2 * k + 1
                return k - self.size
            k >>= 1
        return -1


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Best-fit-decreasing plan for ``counts`` pieces of each length.

    Returns rows (length, first rank, first bin, offset) -- pieces of that
    length from that rank on go to consecutive bins at that offset, until the
    next row -- and the number of bins."""
    open_, bins, plan = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            left = open_.tightest(length)
            if left < 0:  # each new bin takes one piece before another is opened
                per = min(todo, capacity // length)
                n = todo // per
                for k in range(per):
                    plan.append((length, rank + k * n, bins, k * length))
                first, bins = bins, bins + n
                rank, todo = rank + n * per, todo - n * per
                left = capacity - per * length
            else:
                first, n = open_.take(left, todo)
                plan.append((length, rank, first, capacity - left))
                rank, todo, left = rank + n, todo - n, left - length
            if left:
                open_.add(left, first, n)
    return np.array(plan, np.int64).reshape(-1, 4), bins


def _ranked(p: DataFrame) -> DataFrame:
    """Add ``rank``: the place of each piece among those of its length."""
    per = p.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = F.row_number().over(Window.partitionBy("task", "length").orderBy("row", "piece")) - 1
    return p.withColumn("own", own).join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("own")) \
        .drop("own", "base")


def _place(plan: np.ndarray, names: list[str]):
    # plan rows sorted by (length, first rank) as the keys of one binary search
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    starts = {int(k): int(v) for v, k in reversed(list(enumerate(plan[:, 0].tolist())))}
    ends = {int(k): v + 1 for v, k in enumerate(plan[:, 0].tolist())}
    ranks = plan[:, 1].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens, rank = b.column(names.index("length")).to_pylist(), b.column(names.index("rank")).to_pylist()
            k = np.array([bisect_right(ranks, r, starts[n], ends[n]) - 1 for n, r in zip(lens, rank)], np.int64)
            got = plan[k] if len(k) else np.zeros((0, 4), np.int64)
            seq = got[:, 2] + np.array(rank, np.int64) - got[:, 1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seq), pa.array(got[:, 3])],
                                             names=[*names, "sequence_id", "offset"])
    return run


def assign(p: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with task, row, piece, length."""
    counts = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    plan, _ = best_fit(counts, capacity)
    r = _ranked(p)
    return r.mapInArrow(_place(plan, r.columns), r.withColumns({"sequence_id": F.lit(0).cast("long"),
                                                                "offset": F.lit(0).cast("long")}).schema)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, task, row.  The ids themselves are in the stored pieces."""
    p = pieces(docs, doc_id, text, path, capacity, end_id)
    slim = p.select("doc_id", "task", "row", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return assign(written(slim, "piece-lengths"), capacity)


def sequences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
              capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences, at most ``capacity``
    ids each, as little-endian 32-bit integers in place order."""
    p = pieces(docs, doc_id, text, path, capacity, end_id)
    a = assign(p.select("task", "row", "piece", "length"), capacity)
    both = p.select("task", "row", "piece", "ids").join(a, ["task", "row", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("x"))))  # one sequence
    return both.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p")) \
        .select("sequence_id", "n_tokens", F.unhex(F.array_join(F.transform("p", lambda q: q["x"]), "")).alias("ids"))
