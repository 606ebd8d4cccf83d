"""Table sinks: replace with declared schema and clustering, append by name."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbside.session import checkpoint_dir


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, under the shared checkpoint dir."""
    root = checkpoint_dir(spark)
    return os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns *by name*, cast to the declared types.

    Missing columns become typed NULLs; extra columns are dropped.  Writing
    by name avoids the positional mix-ups of INSERT ... SELECT.
    """
    cols = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def replace_table(df: DataFrame, path: str, schema: StructType | None = None,
                  cluster_by: list[str] | None = None, files_per_range: int | None = None) -> str:
    """Create-or-replace a Parquet table; optionally cluster rows by columns.

    Clustering = range-partition on the cluster columns, then sort inside
    each file, so every file covers a narrow key range and Parquet min/max
    statistics let later scans skip files and row groups.  The number of
    output files follows ``spark.sql.shuffle.partitions`` (AQE may
    coalesce) unless ``files_per_range`` is given.
    """
    out = conform(df, schema) if schema is not None else df
    if cluster_by:
        out = (out.repartitionByRange(files_per_range, *cluster_by) if files_per_range
               else out.repartitionByRange(*cluster_by))
        out = out.sortWithinPartitions(*cluster_by)
    out.write.mode("overwrite").parquet(path)
    return path


def append(df: DataFrame, path: str, schema: StructType | None = None) -> str:
    """INSERT INTO ... SELECT, matched by column name (not position)."""
    if schema is None:
        schema = df.sparkSession.read.parquet(path).schema
    conform(df, schema).write.mode("append").parquet(path)
    return path


def ctas(df: DataFrame, path: str, cluster_by: list[str] | None = None) -> str:
    """CREATE TABLE AS SELECT with inferred schema, clustered by ``cluster_by``."""
    return replace_table(df, path, None, cluster_by)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it back.

    For an intermediate that several reports reuse (the visit fact, the
    consolidated permits), so a lost executor does not force recomputing
    the whole upstream plan.  Uses the reliable ``checkpoint`` (never the
    executor-local variant) in ``spark.checkpoint.dir``.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
