"""Windows whose largest task is bounded, whatever a key holds.

A window ``PARTITION BY key`` is one task per key.  That is right for every key
up to ``limit`` rows and wrong for a key with a third of the table.  So a
windowed operator here has two forms, and each key takes the one its size asks
for:

* keys of up to ``limit`` rows: the plain window, one exchange;
* heavier keys: their rows alone are range-partitioned by (key, order, row),
  so a key is cut into *ranges* of about half the limit at any place of its
  order (inside one day, inside equal times).  The cut is stored, since a
  range must mean the same rows in all that follows.  The window runs inside
  (range, key); one summary row per (range, key) -- count, head, tail, first
  value -- is scanned over the key's ranges, and what a range takes from its
  neighbours is joined back on the columns its rows are partitioned by.

Heavy keys are found by a count per key (map-side combined); there is at most
one per ``limit`` rows of input, so the list is small.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.session import checkpoint_dir

#: Rows of one key that a plain window may hold.
LIMIT = 4_000_000
#: Rows of one task of what is dealt by :func:`spread`.
TASK_ROWS = 125_000


def keyed(df: DataFrame, keys) -> tuple[DataFrame, list[str]]:
    """Add NULL-free columns for the keys: (text value, is NULL) each, so that NULL keys are
    a group as in a window and every later join is a plain equi-join."""
    exprs, names, at = [], [], ""
    while f"__kv0{at}" in df.columns:
        at += "_"
    for i, k in enumerate(keys):
        c = F.col(k) if isinstance(k, str) else k
        exprs += [F.coalesce(c.cast("string"), F.lit("")).alias(f"__kv{i}{at}"), c.isNull().alias(f"__kn{i}{at}")]
        names += [f"__kv{i}{at}", f"__kn{i}{at}"]
    return df.select("*", *exprs), names


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: computed once, survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/ranges/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as ``rows`` rows need.

    Partitions that are joined up by bytes hold ever more rows the better these compress; what a task sorts or
    groups is rows.  Sides that are spread by the same number of rows join without another exchange."""
    return df.repartition(max(1, math.ceil(rows / TASK_ROWS)), *keys)


def heavy_keys(df: DataFrame, names: list[str], limit: int) -> tuple[DataFrame | None, int]:
    """The key columns of keys with more than ``limit`` rows, and the rows they hold."""
    found = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    # at most one row per ``limit`` rows of the input
    rows = found.collect()
    if not rows:
        return None, 0
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], found.schema).drop("__n"), sum(r["__n"] for r in rows)


def range_rows(df: DataFrame, names: list[str], spec: list[Column], rows: int, limit: int) -> DataFrame:
    """``df`` cut into ranges of about ``limit / 2`` rows by (key, order, row): the range is ``__p``,
    which ascends along the order of each key; ``__row`` tells equal rows apart."""
    parts = max(2, math.ceil(2 * rows / limit))
    cut = df.withColumn("__row", F.monotonically_increasing_id()) \
        .repartitionByRange(parts, *[F.col(n) for n in names], *spec, F.col("__row"))
    return stored(cut.withColumn("__p", F.spark_partition_id()), "rows")


def bounded(df: DataFrame, keys, spec: list[Column], plain: Callable[[DataFrame], DataFrame],
            split: Callable[[DataFrame, list[str]], DataFrame], limit: int | None) -> DataFrame:
    """``plain(rows)`` for the keys of up to ``limit`` rows, ``split(ranges, key columns)`` for heavier ones.

    ``split`` gets the rows with ``__p``, ``__row`` and the key columns, and both return the same
    columns.  ``limit=None`` is the plain window for all keys.
    """
    if limit is None:
        return plain(df)
    k, names = keyed(df, keys)
    heavy, rows = heavy_keys(k, names, limit)
    if heavy is None:
        return plain(df)
    light = plain(k.join(heavy, names, "left_anti").select(*df.columns))
    return light.unionByName(split(range_rows(k.join(heavy, names, "left_semi"), names, spec, rows, limit), names))


class Ranges:
    """Windows inside (range, key) and over a key's ranges."""

    def __init__(self, rows: DataFrame, names: list[str], spec: list[Column]):
        self.rows, self.names = rows, names
        self.inside = Window.partitionBy("__p", *names).orderBy(*spec, "__row")
        self.over = Window.partitionBy(*names).orderBy("__p")

    def summary(self, *aggs: Column) -> DataFrame:
        """One row per (range, key)."""
        return self.rows.groupBy("__p", *self.names).agg(*aggs)

    def _edge(self, order: list[str], cols: list[str]) -> Column:
        """Compares as the rows do: the order's columns, then the row; then the values asked for."""
        return F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], F.col("__row"),
                        *[F.col(c).alias(f"__v{i}") for i, c in enumerate(cols)])

    def first(self, order: list[str], cols: list[str], present: str | None = None) -> DataFrame:
        """``__e``: the values of each range's first row (of the first where ``present`` is not NULL)."""
        e = self._edge(order, cols)
        return self.summary(F.min(e if present is None else F.when(F.col(present).isNotNull(), e)).alias("__e"))

    def last(self, order: list[str], cols: list[str], descending: bool = False) -> DataFrame:
        """``__e``: the values of each range's last row.  A descending order ends on its least row; of rows
        that are equal in the order the last by number."""
        if not descending:
            return self.summary(F.max(self._edge(order, cols)).alias("__e"))
        e = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], (-F.col("__row")).alias("__row"),
                     *[F.col(c).alias(f"__v{i}") for i, c in enumerate(cols)])
        return self.summary(F.min(e).alias("__e"))

    def joined(self, inner: DataFrame, carried: DataFrame) -> DataFrame:
        return inner.join(carried, ["__p", *self.names], "left")
