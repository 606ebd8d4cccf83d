"""Token ids in files of independently decodable Huffman blocks.

Texts are encoded once and their ids stored; global id counts (at most one
per vocabulary entry) give a canonical, length-limited Huffman code by
package-merge.  The rows are then sorted by id over range partitions, and
each task writes blocks of whole documents: payload bits, the documents' ids
and token counts, and a bit-offset checkpoint every ``STRIDE`` tokens.  A
block needs nothing but the code lengths to be read; its checkpoints are
decoded side by side with one table of 2^16 entries.

The files are Parquet folders under one path: ``blocks`` (one row per block)
and ``code`` (id, length), written and read by Spark, so they may live in
any store that Spark reaches.

Defined results: a NULL or empty text is the end id alone; ids ascend with
NULLs first, equal ids in input order; an empty table gives no blocks; a
very long text is one block; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import scratch, small_batches, written
from kerbside.llm.tokens import default_path, encoder

END_ID = 2
MAX_BITS = 16
#: Tokens between checkpoints, and tokens after which a block ends.
STRIDE, BLOCK_TOKENS = 512, 1 << 16

_IDS = "doc_id long, task int, row long, ids binary"
_BLOCKS = ("part int, block int, start_in_part long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
           "checkpoints array<long>, payload binary")
_DOCS = "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long"


# ---------------------------------------------------------------- the code

def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code length of each id under ``limit`` bits (0: the id never
    occurs), by package-merge."""
    ids = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(ids)
    if n > 1 << limit:
        raise ValueError("more ids than codes of that length")
    if n < 2:
        out[ids] = 1
        return out
    order = ids[np.argsort(counts[ids], kind="stable")]
    leaves = counts[order].astype(np.float64)
    merged, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        m = len(merged) // 2 * 2
        both = np.concatenate([leaves, merged[0:m:2] + merged[1:m:2]])
        o = np.argsort(both, kind="stable")
        merged = both[o]
        is_leaf.append(o < n)
    length, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_leaf):
        k = int(flags[:take].sum())
        length[:k] += 1
        take = 2 * (take - k)
    out[order] = length
    return out


def canonical(length: np.ndarray) -> np.ndarray:
    """Canonical code of each id: codes ascend with (length, id)."""
    ids = np.flatnonzero(length)
    ids = ids[np.lexsort((ids, length[ids]))]
    code = np.zeros(len(length), np.uint64)
    now, last = 0, 0
    for i, n in zip(ids.tolist(), length[ids].tolist()):
        now <<= n - last
        code[i], last = now, n
        now += 1
    return code


def decode_table(length: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(id, length) for every possible next ``limit`` bits."""
    code = canonical(length)
    sym, n = np.zeros(1 << limit, np.uint16), np.ones(1 << limit, np.int64)
    for i in np.flatnonzero(length).tolist():
        k = limit - int(length[i])
        a = int(code[i]) << k
        sym[a: a + (1 << k)], n[a: a + (1 << k)] = i, length[i]
    return sym, n


def encode_block(ids: np.ndarray, length: np.ndarray, code: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(payload, bit offset of every STRIDE-th token)."""
    n = length[ids].astype(np.int64)
    end = np.cumsum(n)
    pos = end - n
    word, shift = pos >> 6, 64 - (pos & 63) - n
    c = code[ids]
    out = np.zeros((int(end[-1]) >> 6) + 2, np.uint64)
    main = np.where(shift >= 0, c << np.maximum(shift, 0).astype(np.uint64), c >> np.maximum(-shift, 0).astype(np.uint64))
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.bitwise_or.reduceat(main, first)
    over = np.flatnonzero(shift < 0)
    out[word[over] + 1] |= c[over] << (64 + shift[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: (int(end[-1]) + 7) >> 3], pos[::STRIDE]


def decode_blocks(payloads: list[bytes], checkpoints: list[np.ndarray], n_tokens: list[int],
                  table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """ids of some blocks, one after the other: all checkpoints advance together."""
    sym, length = table
    size = np.array([len(p) for p in payloads], np.int64)
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(payloads) + bytes(4), np.uint8).astype(np.uint32)
    three = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    lanes = [np.asarray(c, np.int64) for c in checkpoints]
    pos = np.concatenate([c + 8 * b for c, b in zip(lanes, base)])
    each = np.concatenate([np.minimum(STRIDE, n - STRIDE * np.arange(len(c))) for c, n in zip(lanes, n_tokens)])
    steps, last = int(each.max()), len(three) - 1
    out = np.empty((steps, len(pos)), np.uint16)
    for k in range(steps):
        at = np.minimum(pos >> 3, last)  # lanes past their last token read padding
        x = (three[at] >> (8 - (pos & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        out[k] = sym[x]
        pos += length[x]
    return out.T[np.arange(steps) < each[:, None]]


# ---------------------------------------------------------------- Spark jobs

def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, row = encoder(path), TaskContext.get().partitionId(), 0
        for b in batches:
            flat, off = enc.encode(b.column(1).to_pylist())
            end = np.uint16(end_id).tobytes()
            ids = [flat[off[i]: off[i + 1]].astype("<u2").tobytes() + end for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([task] * b.num_rows, pa.int32()), pa.array(range(row, row + b.num_rows), pa.int64()),
                 pa.array(ids, pa.binary())], names=["doc_id", "task", "row", "ids"])
            row += b.num_rows
    return run


def token_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
              end_id: int = END_ID) -> DataFrame:
    """(doc_id, task, row, ids): stored ids as little-endian 16-bit integers."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return written(d.mapInArrow(_encode(path or default_path(), end_id), _IDS), "token-ids")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for b in batches:
        for x in b.column(0):
            total += np.bincount(np.frombuffer(x.as_buffer(), "<u2"), minlength=1 << 16)
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids], pa.int64())], names=["id", "n"])


def _count_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def joined():
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(b.column(0).to_pylist())], pa.binary())], names=["ids"])
    yield from _count(joined())


def id_counts(ids: DataFrame) -> np.ndarray:
    """Global count of every id: one row per id and task, summed; the driver
    gets one number per vocabulary entry."""
    per = ids.select("ids").mapInArrow(_count_joined, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << 16, np.int64)
    for r in per.collect():
        out[r["id"]] = r["n"]
    return out


def _blocks(length: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = canonical(length), TaskContext.get().partitionId()
        block, start, docs, parts, tokens = 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            payload, marks = encode_block(np.concatenate(parts), length, code)
            cols = ([part], [block], [start], [tokens], [docs], [[len(p) for p in parts]], [marks.tolist()], [payload])
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=["part", "block", "start_in_part", "n_tokens", "doc_ids", "doc_tokens",
                                                     "checkpoints", "payload"])
        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(x, "<u2")
                docs.append(d)
                parts.append(x)
                tokens += len(x)
                if tokens >= BLOCK_TOKENS:
                    yield flush()
                    block, start, docs, parts, tokens = block + 1, start + tokens, [], [], 0
        if docs:
            yield flush()
    return run


def write_tokens(docs: DataFrame, to: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
                 end_id: int = END_ID) -> None:
    """Write the token files of ``docs`` under ``to``, in ascending doc_id order."""
    spark = docs.sparkSession
    ids = token_ids(docs, doc_id, text, path, end_id)
    length = code_lengths(id_counts(ids))
    used = np.flatnonzero(length)
    spark.createDataFrame(list(zip(used.tolist(), length[used].tolist())), "id int, length int") \
        .coalesce(1).write.parquet(f"{to}/code")
    order = [F.col("doc_id").asc_nulls_first(), F.col("task"), F.col("row")]
    dealt = ids.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    dealt.mapInArrow(_blocks(length), _BLOCKS).write.option("compression", "none").parquet(f"{to}/blocks")


def _decode(length: np.ndarray, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(length)
        for whole in batches:
            for at in range(0, whole.num_rows, 32):
                b = whole.slice(at, 32)
                col = dict(zip(b.schema.names, b.columns))
                counts = col["doc_tokens"].to_pylist()
                ids = decode_blocks(col["payload"].to_pylist(), [np.array(c) for c in col["checkpoints"].to_pylist()],
                                    col["n_tokens"].to_pylist(), table).astype("<u4")
                out: list[list] = [[], [], [], [], [], []]
                i = 0
                for part, start, docs, ns in zip(col["part"].to_pylist(), col["start_in_part"].to_pylist(),
                                                 col["doc_ids"].to_pylist(), counts):
                    for d, n in zip(docs, ns):
                        raw = ids[i: i + n].tobytes()
                        for c, v in zip(out, (d, part, start, n, zlib.crc32(raw), raw)):
                            c.append(v)
                        i, start = i + n, start + n
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32", "ids"]
                k = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:k], types)], names=names[:k])
    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) decoded from the files;
    ``start`` counts the ids of all documents before."""
    small_batches(spark)
    length = np.zeros(1 << 16, np.uint8)
    for r in spark.read.parquet(f"{path}/code").collect():  # one row per used vocabulary entry
        length[r["id"]] = r["length"]
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    per = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per written file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    docs = blocks.mapInArrow(_decode(length, with_ids), _DOCS + (", ids binary" if with_ids else ""))
    return docs.join(base, "part").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens",
                                          "ids_crc32", *["ids"] * with_ids)


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
               to: str | None = None) -> DataFrame:
    """Write the files of ``docs`` (to a new scratch folder unless ``to`` is given) and read them back."""
    spark = docs.sparkSession
    to = to or scratch(spark, "token-files")
    write_tokens(docs, to, doc_id, text, path)
    return read_tokens(spark, to)
