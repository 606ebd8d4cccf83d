"""Tables that are replaced as a whole or by day, so that a failed write changes nothing.

A table is a folder with ``data/<version>/`` folders and a ``log``.  A write goes
to a new version folder; only when it has ended does one appended log row make
it current.  A reader takes the newest log row, or for a table kept by day the
newest of each day, and opens those folders.  So a failed or running write is
never seen, days that were not rebuilt keep their files, and a reader in the
middle of a write keeps the version it opened.  Writers of one table take turns.

Clustering is by interleaved ranks: the bits of each column's rank among up to
255 sampled bounds are woven into one number, rows are range-partitioned and
sorted by it, so files are narrow in *every* cluster column.  Ranges end
within equal values too (the row number is the last key), so a site with a third
of the rows spans files.  Files hold about ``max_file_bytes``.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbside.operators import windows as W
from kerbside.sources.sinks import conform

#: Bytes of one file, rows of the sample that the bounds and the row size come from, bits of one column's rank.
FILE_BYTES, SAMPLE_ROWS, BITS = 256 << 20, 50_000, 8
_LOG = "seq long, part string, version string, columns string, comment string"


def described(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``df`` with a description in the metadata of each named column (kept in the files' schema)."""
    for c, text in columns.items():
        df = df.withMetadata(c, {**df.schema[c].metadata, "comment": text})
    return df


def _rank(c: Column, bounds: list[Column]) -> Column:
    """How many of the bounds are at most ``c``; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    return F.when(c.isNull(), 0).otherwise(F.size(F.filter(F.array(*bounds), lambda b: b <= c)))


def interleaved(df: DataFrame, cols: Sequence[str], max_file_bytes: int = FILE_BYTES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` in file-sized ranges of the interleaved ranks of ``cols``, sorted within each."""
    n = df.count()
    near = df.select(*cols, F.octet_length(F.to_json(F.struct("*"))).alias("__bytes")).sample(min(1.0, sample_rows / max(n, 1)), 7)
    rows = near.collect()  # about sample_rows rows
    mean = sum(r["__bytes"] for r in rows) / len(rows) if rows else 1
    files = max(1, math.ceil(n * mean / max_file_bytes))
    ranks = []
    for c in cols:
        seen = sorted(r[c] for r in rows if r[c] is not None)
        bounds = sorted({seen[len(seen) * i // 2 ** BITS] for i in range(1, 2 ** BITS)}) if seen else []
        kind = df.schema[c].dataType
        ranks.append(_rank(F.col(c), [F.lit(b).cast(kind) for b in bounds]))
    z: Column = F.lit(0).cast("long")
    for b in range(BITS):
        for i, r in enumerate(ranks):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(r, b).bitwiseAND(1).cast("long"), b * len(ranks) + i))
    out = df.withColumns({"__z": z, "__row": F.monotonically_increasing_id()})
    return out.repartitionByRange(files, "__z", *cols, "__row").sortWithinPartitions("__z", *cols).drop("__z", "__row")


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG).parquet(f"{path}/log")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def _commit(spark: SparkSession, path: str, parts: Mapping[str, str | None], schema: StructType, comment: str | None) -> None:
    old = _log(spark, path)
    seq = 1 + ((old.agg(F.max("seq")).first()[0] or 0) if old is not None else 0)
    rows = [(seq, p, v, schema.json(), comment) for p, v in parts.items()]
    # one task, one file: the whole commit appears at once
    spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").parquet(f"{path}/log")


def publish(df: DataFrame, path: str, schema: StructType | None = None, cluster_by: Sequence[str] = (), comment: str | None = None,
            columns: Mapping[str, str] | None = None, max_file_bytes: int = FILE_BYTES) -> str:
    """Create or replace the table at ``path``; returns the version."""
    out = conform(df, schema) if schema is not None else df
    if cluster_by:
        out = interleaved(out, list(cluster_by), max_file_bytes)
    out = described(out, columns or {})
    version = uuid.uuid4().hex[:12]
    out.write.parquet(f"{path}/data/{version}")
    _commit(df.sparkSession, path, {"": version}, out.schema, comment)
    return version


def publish_days(df: DataFrame, path: str, day: str, days: Iterable | None = None, comment: str | None = None) -> list[str]:
    """Replace the given days (all days of ``df`` if None) of a table kept by ``day``; a given day without
    rows becomes empty.  Rows of ``df`` on other days are not written.  Returns the days replaced."""
    spark = df.sparkSession
    days = None if days is None else sorted({str(d) for d in days})
    if days is not None and not days:
        return []
    if days is not None:
        df = df.where(F.col(day).cast("string").isin(days))
    version = uuid.uuid4().hex[:12]
    root = f"{path}/data/{version}"
    df.withColumn("__day", F.col(day).cast("string")).repartition(F.col("__day"), F.pmod(F.hash(*df.columns), F.lit(4))) \
        .write.partitionBy("__day").parquet(root)
    there = spark.read.option("basePath", root).parquet(root) if _any(spark, root) else None
    written = {str(r[0]) for r in there.select(F.col("__day").cast("string")).distinct().collect()} if there is not None else set()
    parts = {d: (version if d in written else None) for d in (days if days is not None else sorted(written))}
    _commit(spark, path, parts, df.schema, comment)
    return list(parts)


def _any(spark: SparkSession, root: str) -> bool:
    try:
        return bool(spark.read.option("basePath", root).parquet(f"{root}/__day=*").columns)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return False


def current_paths(spark: SparkSession, path: str) -> tuple[list[str], StructType, str | None]:
    """The folders of the current table, its schema and its description."""
    log = _log(spark, path)
    if log is None:
        raise FileNotFoundError(f"no table at {path}")
    new = W.latest_by_key(log, "part", "seq", tiebreak="version").collect()
    last = max(new, key=lambda r: r["seq"])
    folders = [f"{path}/data/{r['version']}" + (f"/__day={r['part']}" if r["part"] else "") for r in new if r["version"]]
    return sorted(folders), StructType.fromJson(json.loads(last["columns"])), last["comment"]


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The current table."""
    folders, schema, _ = current_paths(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def add_rows(df: DataFrame, path: str) -> str:
    """Append by column name: the current rows' folders stay, the new rows come as a part of their own."""
    spark = df.sparkSession
    _, schema, comment = current_paths(spark, path)
    version = uuid.uuid4().hex[:12]
    conform(df, schema).write.parquet(f"{path}/data/{version}/__day=+{version}")
    _commit(spark, path, {f"+{version}": version}, schema, comment)
    return version


def touched_days(revisions: DataFrame, added: DataFrame, current: DataFrame, key: str, day: Column, current_day: str) -> list:
    """Days that ``added`` revisions may change: those of every revision of their items, and those on which
    the current table has these items."""
    ids = added.select(key).distinct()
    parts = [revisions.join(ids, key, "left_semi").select(day.alias("d")), current.join(ids, key, "left_semi").select(F.col(current_day).alias("d"))]
    rows = reduce(DataFrame.unionByName, parts).where("d IS NOT NULL").distinct()
    return [r["d"] for r in rows.collect()]  # one row per day
