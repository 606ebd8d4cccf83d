"""Table scans: single tables, wildcard shard families, per-org unions."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def table_path(base: str, name: str) -> str:
    return os.path.join(base, f"{name}.parquet")


def scan(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one table.  Column pruning and filter pushdown are Catalyst's."""
    return spark.read.parquet(table_path(base, name))


def scan_glob(spark: SparkSession, base: str, prefix: str,
              shard_col: str | None = None, exact_prefix: bool = True) -> DataFrame:
    """Read every shard ``<prefix>*`` of a table family in one scan.

    A plain glob ``prefix*`` also matches longer family names that share the
    prefix (``visits_ab*`` also catches ``visits_abc*``).  With ``exact_prefix`` the
    shard suffix must not start with a letter, so only ``prefix``,
    ``prefix_2024`` or ``prefix2`` style shards are kept.  The suffix test
    runs on ``_metadata.file_path`` -- a column-level filter, so the scan is
    still one distributed read.  ``shard_col`` keeps the shard name.
    """
    df = spark.read.parquet(os.path.join(base, f"{prefix}*"))
    base_re = _escape(os.path.normpath(base))
    rel = F.regexp_extract(F.col("_metadata.file_path"), base_re + r"/([^/]+)", 1)
    rel = F.regexp_replace(rel, r"\.parquet$", "")
    if exact_prefix:
        df = df.where(~rel.rlike("^" + _escape(prefix) + "[A-Za-z]"))
    if shard_col:
        df = df.withColumn(shard_col, rel)
    return df


def _escape(s: str) -> str:
    return "".join("\\" + c if c in r".^$*+?{}[]\|()" else c for c in s)


def union_orgs(dfs: Iterable[DataFrame], org_names: Iterable[str] | None = None,
               org_col: str = "org") -> DataFrame:
    """Union the same projection of per-organisation tables by column name.

    One logical plan (a ``Union`` node); every branch keeps its own scan
    with its own pushed filters.  ``org_names`` tags each branch.
    """
    dfs = list(dfs)
    if org_names is not None:
        dfs = [d.withColumn(org_col, F.lit(n)) for d, n in zip(dfs, org_names)]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def register_tables(spark: SparkSession, base: str, names: Iterable[str] = DRIVER_TABLES) -> None:
    """Temp views over the driver tables, for ``spark.sql`` users."""
    for n in names:
        scan(spark, base, n).createOrReplaceTempView(n)


def run_sql(spark: SparkSession, sql: str, frames: dict[str, DataFrame] | None = None, **params) -> DataFrame:
    """Parameterised query: ``:name`` markers bound from keyword arguments.

    ``frames`` names DataFrames referenced as ``{name}`` in the text; values
    are bound as typed literals by Spark (no string splicing), so a report
    date or organisation id cannot change the query's shape.
    """
    return spark.sql(sql, args=params or None, **(frames or {}))


def literal_table(spark: SparkSession, rows, columns: list[str]) -> DataFrame:
    """A small literal table as a local relation (``VALUES``).

    Unlike ``createDataFrame`` over a Python list, a local relation carries
    its exact size, so the planner knows it is tiny and broadcasts it in
    joins without a hint.
    """
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")
