"""Shards of bounded size by extendible hashing.

Every row has a string of hash bits: 64 of its key columns, 64 of the whole
row, 64 of its place in the input.  The directory starts with one bucket; a
bucket whose rows exceed the byte limit splits on its next bit, and only
such buckets do, until every shard fits.  Sizes by prefix come from one
aggregation that looks some bits ahead, so many levels of splits cost one
pass; buckets that still don't fit are taken up again with more bits, and
rows with equal key bits (a hot key) jump straight to the bits that tell
them apart.

Defined results: a NULL key hashes like any other value; rows equal in all
columns are told apart by their place; a single row above the limit is a
shard of its own (``oversized``); an empty table has no shards; extra
columns stay (those of the result are named by parameters).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import scratch, written

#: Bytes of text of one shard at most.
LIMIT = 64 << 20
#: Bits that one pass looks beyond the depth at which the average bucket fits.
AHEAD = 6
BITS = 192


def _bits(c: str) -> Column:
    return F.lpad(F.bin(F.col(c)), 64, "0")


def _addressed(docs: DataFrame, key: list[str], size: Column, carry: list[str]) -> DataFrame:
    """(row, bits, size): the carried columns and the address of each row."""
    def with_nulls(cols: list[str]) -> list[Column]:
        return [x for c in cols for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    plain = [c for c in docs.columns if not isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType))]
    d = docs.select(F.xxhash64(*with_nulls(key)).alias("a"), F.xxhash64(*with_nulls(plain)).alias("b"),
                    F.xxhash64(F.monotonically_increasing_id()).alias("c"), size.cast("long").alias("size"),
                    F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"))
    # written once, so that a repeated task can't change a row's place
    return written(d.select("row", F.concat(_bits("a"), _bits("b"), _bits("c")).alias("bits"), "size"), "addresses")


def _split(cells: DataFrame, limit: int) -> DataFrame:
    """Leaves among the prefixes of the cells: (leaf, cell, fits).  Cells carry
    ``low``: a depth at which their bucket is known to exceed the limit or is the root."""
    up = cells.select("cell", "bytes", "n", "low", F.explode(F.sequence(F.col("low"), F.length("cell"))).alias("d")) \
        .select("cell", "low", "d", F.substring("cell", F.lit(1), F.col("d")).alias("prefix"), "bytes", "n")
    sums = up.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    fit = sums.where((F.col("bytes") <= limit) | (F.col("n") == 1) | (F.length("prefix") == BITS)).select("prefix")
    leaf = up.join(fit, "prefix").groupBy("cell").agg(F.min(F.struct("d", "prefix")).alias("m")) \
        .select("cell", F.col("m.prefix").alias("shard"))
    return cells.join(leaf, "cell", "left").select("cell", "shard", "lo", "hi")


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(cell, shard): each cell (a prefix of bits) and the shard it belongs to;
    every row has exactly one cell in it.  ``rows`` has bits and size."""
    spark = rows.sparkSession
    total = rows.agg(F.sum("size").alias("s")).first()["s"] or 0
    depth = max(0, math.ceil(math.log2(max(1, total / limit)))) + AHEAD
    todo, path = rows.select("bits", "size", F.lit(0).alias("low"), F.lit(depth).alias("depth")), scratch(spark, "directory")
    while True:
        cell = F.substring("bits", F.lit(1), F.col("depth"))
        cells = todo.groupBy(cell.alias("cell"), "low").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("bits").alias("lo"), F.max("bits").alias("hi"))
        got = written(_split(cells, limit), "cells")
        got.where("shard IS NOT NULL").select("cell", "shard").write.mode("append").parquet(path)
        over = got.where("shard IS NULL")
        if over.isEmpty():
            return spark.read.schema("cell string, shard string").parquet(path)
        # the first bit in which the cell's rows differ, and some more
        same = F.length(F.regexp_extract(F.concat("lo", F.lit(":"), "hi"), r"^([01]*)[01]*:\1", 1))
        over = over.select("cell", F.length("cell").alias("was"), same.cast("int").alias("low")) \
            .select("cell", "was", "low", F.least(F.col("low") + AHEAD, F.lit(BITS)).alias("next"))
        over = written(over, "oversized-cells")
        todo = _in_cells(rows, over).select("bits", "size", "low", F.col("next").alias("depth"))


def _in_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows joined to the cell that is a prefix of their bits; a cell table has few distinct depths."""
    depths = [r["d"] for r in cells.select(F.length("cell").alias("d")).distinct().collect()]  # at most BITS
    out = None
    for d in sorted(depths) or [0]:
        part = rows.withColumn("cell", F.substring("bits", F.lit(1), F.lit(d))) \
            .join(cells.where(F.length("cell") == d), "cell")
        out = part if out is None else out.unionByName(part)
    return out


def shards(docs: DataFrame, key: list[str], size: Column, limit: int = LIMIT) -> DataFrame:
    """The key columns of every row with its shard (named by a prefix of bits),
    the shard's depth and the row's bytes."""
    rows = _addressed(docs, key, size, key)
    return _in_cells(rows, directory(rows, limit)) \
        .select("row.*", "shard", F.length("shard").alias("depth"), F.col("size").alias("bytes"))


def shard_sizes(assigned: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(shard, n_rows, bytes, oversized): the directory's buckets."""
    return assigned.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("bytes").alias("bytes")) \
        .withColumn("oversized", F.col("bytes") > limit)


def write_shards(docs: DataFrame, to: str, key: list[str], size: Column, limit: int = LIMIT, shard_col: str = "shard") -> None:
    """Write ``docs``, all columns, as one Parquet folder per shard: a shard is
    at most ``limit`` bytes (or one row), so one task writes it."""
    rows = _addressed(docs, key, size, docs.columns)
    placed = _in_cells(rows, directory(rows, limit)).select("row.*", F.col("shard").alias(shard_col))
    placed.repartition(shard_col).write.partitionBy(shard_col).parquet(to)
