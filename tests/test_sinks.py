"""Sinks: declared schema, clustered layout, append by name, wildcard scans."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.sources import sinks
from kerbside.sources.tables import scan_glob, union_orgs

SCHEMA = T.StructType([T.StructField("region", T.StringType()), T.StructField("site", T.StringType()),
                       T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType())])


def test_replace_table_conforms_and_clusters(spark):
    rows = [(f"r{i % 3}", f"s{i % 7}", i, dt.datetime(2024, 1, 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "region string, site string, amount int, extra timestamp_ntz")
    path = sinks.scratch_table_path(spark, "t")
    sinks.replace_table(df, path, SCHEMA, cluster_by=["region", "site"], files_per_range=3)
    back = spark.read.parquet(path)
    assert [f.name for f in back.schema.fields] == ["region", "site", "amount", "note"]
    assert back.schema["amount"].dataType == T.DoubleType()
    assert back.where(F.col("note").isNotNull()).count() == 0
    assert back.count() == 200
    # each file holds one contiguous, sorted key range
    per_file = back.select("region", "site", F.input_file_name().alias("f")).groupBy("f").agg(
        F.min(F.concat("region", "site")).alias("lo"), F.max(F.concat("region", "site")).alias("hi")).collect()
    spans = sorted((r.lo, r.hi) for r in per_file)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_append_matches_by_name(spark):
    path = sinks.scratch_table_path(spark, "a")
    first = spark.createDataFrame([("r1", "s1", 1.0, "x")], SCHEMA)
    sinks.replace_table(first, path, SCHEMA)
    second = spark.createDataFrame([("y", 2.0, "s2", "r2")], "note string, amount double, site string, region string")
    sinks.append(second, path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [("r1", "s1", 1.0, "x"), ("r2", "s2", 2.0, "y")]


def test_scan_glob_exact_prefix(spark, tmp_path):
    base = str(tmp_path)
    for name, n in (("visits_ab", 3), ("visits_ab_2024", 2), ("visits_abc", 5)):
        spark.range(n).write.parquet(os.path.join(base, f"{name}.parquet"))
    got = scan_glob(spark, base, "visits_ab", shard_col="shard")
    counts = {r.shard: r["count"] for r in got.groupBy("shard").count().collect()}
    assert counts == {"visits_ab": 3, "visits_ab_2024": 2}
    loose = scan_glob(spark, base, "visits_ab", exact_prefix=False)
    assert loose.count() == 10


def test_union_orgs_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id long, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id long")
    u = union_orgs([a, b], ["o1", "o2"])
    assert sorted(tuple(r) for r in u.collect()) == [(1, "x", "o1"), (2, "y", "o2")]
