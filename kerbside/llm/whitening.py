"""Whitening of embeddings with MLlib block matrices.

Each entry c becomes x = floor(scale * c) + offset.  With n rows and the exact
sums S of each dimension, row i is centred as (n * x - S) / n (the numerator
is an exact integer, so the offset costs no digits), numbered densely and
laid into blocks of about a megabyte.  BlockMatrix does the rest: transpose
times itself gives the scatter matrix, whose d x d result is decomposed on the
driver, and a multiplication by the whitening matrix projects all rows.

Blocks are handled in *panels* of at most ``PANEL_BLOCKS``: MLlib's grid of a
tall matrix has only about the root of its partitions as tasks, and it numbers
rows by 32-bit integers, so a panel bounds both (about 32 MB a task).  The
scatter matrices of the panels are added.  The driver holds d x d numbers, d
being the length of a vector, and the block numbers of one panel.

Defined results: rows whose vector is NULL, or holds NULL or non-finite
entries, are dropped; so are rows whose vector has another length than most
(the longer length wins a tie); copies and NULL ids stay as rows of their
own; components beyond the numerical rank (eigenvalue at most ``RANK`` of the
trace) have no whitened value and give no row, so equal vectors alone, or an
empty table, give an empty result.  Sums beyond 64 bits raise an error
instead of wrapping.  Other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, Vectors
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import written

#: Components returned.
TOP = 32
#: Numbers of one block (1 MB).
BLOCK_CELLS = 1 << 17
#: Blocks of one panel.
PANEL_BLOCKS = 1024
#: Blocks that one task of the transpose-multiply holds.
BLOCKS_PER_TASK = 8
#: Share of the trace at which an eigenvalue counts as zero.
RANK = 1e-12

RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _longs(values) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _integers(df: DataFrame, id_col: str, vec_col: str, scale: int, offset: int) -> tuple[DataFrame, int]:
    """(vid, x, pos) of the rows that take part, stored, and the length of a vector."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double"))
    fine = F.forall("v", lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    x = F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c) + F.lit(offset).cast("long"))
    rows = df.select(F.col(f"`{id_col}`").alias("vid"), v.alias("v")).where(F.col("v").isNotNull() & fine)
    rows = written(rows.select("vid", x.alias("x"), F.monotonically_increasing_id().alias("pos")), "whitening-rows")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).take(1)
    return rows, lengths[0]["d"] if lengths else 0


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``idx``, a dense number from 0 (from the stored partition and place)."""
    part = F.shiftrightunsigned("pos", 33).alias("part")
    low = Window.partitionBy("part").orderBy("pos")
    # one row per stored partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy(part).agg(F.count("*").alias("c")) \
        .select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    return rows.withColumn("part", part).withColumn("i", F.row_number().over(low) - 1).join(first, "part") \
        .select("vid", "x", (F.col("before") + F.col("i")).alias("idx"))


def _centred(n: int, sums: list[int], d: int):
    s = np.array(sums, np.int64)

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "height": pa.array([len(x)], pa.int32()),
                         "cells": pa.array([((n * x - s) / n).tobytes()], pa.binary())})

    return run


def _matrix(blocks: DataFrame, first: int, count: int, height: int, rows: int, d: int) -> BlockMatrix:
    """One panel as a BlockMatrix."""
    mine = blocks.where(F.col("block").between(first, first + count - 1)).repartition(count)
    cells = mine.rdd.map(lambda r: ((r["block"] - first, 0),
                                    DenseMatrix(r["height"], d, np.frombuffer(r["cells"], np.float64), isTransposed=True)))
    return BlockMatrix(cells, height, d, rows, d)


def _scatter(m: BlockMatrix, count: int) -> np.ndarray:
    """Transpose times itself; the middle dimension is dealt over tasks."""
    splits = max(1, -(-count // BLOCKS_PER_TASK))
    left = m.transpose()
    java = left._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def _small(spark, a: np.ndarray) -> BlockMatrix:
    """A matrix of d rows in one block."""
    rows = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(a)], ["index", "vector"])
    return IndexedRowMatrix(rows, a.shape[0], a.shape[1]).toBlockMatrix(a.shape[0], a.shape[1])


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP, scale: int = 64,
           offset: int = 1_000_000, block_cells: int = BLOCK_CELLS, panel_blocks: int = PANEL_BLOCKS) -> DataFrame:
    """One row per vector and component: the id, component (from 1 by falling eigenvalue), n,
    deviation (exact squared distance from the mean times n squared), whitened, explained
    (share of the trace) and identity_error (largest absolute entry of the whitened rows'
    covariance minus the identity, measured on the projected rows)."""
    spark = df.sparkSession
    rows, d = _integers(df, id_col, vec_col, scale, offset)
    empty = spark.createDataFrame([], df.select(F.col(f"`{id_col}`").alias(id_col)).schema) \
        .select("*", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in RESULT.split(", "))])
    if d == 0:
        return empty
    rows = rows.where(F.size("x") == d)
    sums = [r["s"] for r in rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()]
    n = rows.count()
    height = max(1, block_cells // d)
    off = F.zip_with("x", _longs(sums), lambda a, s: F.lit(n).cast("long") * a - s)
    rows = written(_numbered(rows).withColumn(
        "deviation", F.aggregate(off, F.lit(0).cast("long"), lambda t, v: t + v * v)), "whitening-numbered")
    blocks = written(rows.select("x", "idx", F.floor(F.col("idx") / height).alias("block")).groupBy("block")
                     .applyInArrow(_centred(n, sums, d), "block long, height int, cells binary"), "whitening-blocks")

    panels = []  # (first block, blocks, first row, rows)
    for first in range(0, -(-n // height), panel_blocks):
        count = min(panel_blocks, -(-n // height) - first)
        panels.append((first, count, first * height, min(n, (first + count) * height) - first * height))

    def panel(p) -> BlockMatrix:
        return _matrix(blocks, p[0], p[1], height, p[3], d)

    cov = sum(_scatter(panel(p), p[1]) for p in panels) / n
    e, u = np.linalg.eigh((cov + cov.T) / 2)
    e, u = e[::-1], u[:, ::-1]
    trace = float(np.trace(cov))
    k = int(np.sum(e[:min(top, d)] > RANK * trace)) if trace > 0 else 0
    if k == 0:
        return empty
    whitening = _small(spark, u[:, :k] / np.sqrt(e[:k]))

    second, projected = np.zeros((k, k)), None
    for p in panels:
        y = panel(p).multiply(whitening)
        second += _scatter(y, p[1])
        got = callMLlibFunc("getIndexedRows", y.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        got = got.select((F.col("index") + F.lit(p[2])).alias("idx"), vector_to_array("vector").alias("y"))
        projected = got if projected is None else projected.unionByName(got)
    projected = written(projected, "whitening-projected")
    mean = np.array([r["m"] for r in projected.select(F.posexplode("y")).groupBy("pos").agg(F.avg("col").alias("m"))
                     .orderBy("pos").collect()])
    error = float(np.abs(second / n - np.outer(mean, mean) - np.eye(k)).max())
    share = F.array(*[F.lit(float(v / trace)) for v in e[:k]])
    return rows.select("vid", "idx", "deviation").join(projected, "idx") \
        .select("vid", "deviation", F.posexplode("y").alias("p", "whitened")) \
        .select(F.col("vid").alias(id_col), (F.col("p") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
                "deviation", "whitened", F.get(share, F.col("p")).alias("explained"), F.lit(error).alias("identity_error"))
