"""Shared helpers of the operators: scratch tables, Arrow batches, word hashing."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import checkpoint_dir

#: Rows of one Arrow batch at most: texts may be very long, so few rows make a batch.
BATCH_ROWS = 500
#: Bytes of text that a task hashes at a time.
SLICE_BYTES = 2 << 20
#: Runs of more bytes are hashed by a digest: sums of powers modulo 2^64 let crafted long texts collide.
LONG_RUN = 128


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small (never raises a lower setting)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """64-bit key of a row from its columns; NULLs count (a NULL differs from an
    empty value), repeated rows share a key."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.col(c), F.col(c).isNull()]
    return F.xxhash64(*parts)


# ---------------------------------------------------------------- hashing of words

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_ODD, _INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POW[k] = np.multiply.accumulate(a)
    return _POW[0], _POW[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing hash (vectorised)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts:
    """UTF-8 bytes of some texts with vectorised access to runs and hashes."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off, self.n = buf, off, len(off) - 1
        self._cum: np.ndarray | None = None

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text index, start, end) of each maximal run of bytes for which
        ``inside`` (a bool per byte) holds; runs end with their text."""
        if not len(inside):
            z = np.zeros(0, np.int64)
            return z, z, z
        st, en = inside.copy(), inside.copy()
        st[1:] &= ~inside[:-1]
        en[:-1] &= ~inside[1:]
        full = self.off[1:] > self.off[:-1]
        a, b = self.off[:-1][full], self.off[1:][full] - 1
        st[a], en[b] = inside[a], inside[b]
        s, e = np.flatnonzero(st), np.flatnonzero(en) + 1
        return np.searchsorted(self.off, s, "right") - 1, s, e

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text index, start, end) of every line, split at line feeds; empty lines too."""
        cut = np.flatnonzero(self.buf == 10)
        s = np.concatenate([self.off[:-1], cut + 1])
        e = np.concatenate([cut, self.off[1:]])
        doc = np.concatenate([np.arange(self.n), np.searchsorted(self.off, cut, "right") - 1])
        # a line feed ends one line and begins the next of the same text
        o, p = np.lexsort((s, doc)), np.lexsort((e, np.concatenate([doc[self.n:], np.arange(self.n)])))
        return doc[o], s[o], e[p]

    def hashes(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each run."""
        pw, inv = _powers(len(self.buf) + 1)
        if self._cum is None:
            self._cum = np.zeros(len(self.buf) + 1, np.uint64)
            np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * pw[: len(self.buf)], out=self._cum[1:])
        out = mix64((self._cum[e] - self._cum[s]) * inv[s] + (e - s).astype(np.uint64) * _ODD)
        data = memoryview(np.ascontiguousarray(self.buf))
        for i in np.flatnonzero(e - s > LONG_RUN).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(data[s[i]: e[i]], digest_size=8).digest(), "little")
        return out

    def sums(self, mask: np.ndarray) -> np.ndarray:
        """Count of true bytes of each text."""
        c = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=c[1:])
        return c[self.off[1:]] - c[self.off[:-1]]


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(from, to, Texts) over a string column, about ``limit`` bytes at a time;
    a NULL is an empty text."""
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = min(len(col), max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1))
        yield i, j, Texts(data[off[i]: off[j]], off[i: j + 1] - off[i])
        i = j


def byte_set(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


#: White space of ASCII: space and \t \n \v \f \r.
SPACE = byte_set(b" \t\n\x0b\x0c\r")
