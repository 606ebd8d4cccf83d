"""Physical-plan properties the scale design relies on."""

import re

from pyspark.sql import functions as F

from kerbside.functions.timefn import between_local_days
from kerbside.operators import windows as W

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_local_day_filter_reaches_the_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = plan(ev.where(between_local_days("ts", "Pacific/Auckland", "20240105", "20240110")))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", p).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_column_pruning(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = plan(ev.select("user_id", "ts").where(F.col("user_id") > 3))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert schema == "struct<ts:timestamp_ntz,user_id:bigint>" or schema == "struct<user_id:bigint,ts:timestamp_ntz>"


def test_latest_by_key_is_an_aggregate_not_a_window(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = plan(W.latest_by_key(ev, "user_id", "ts", tiebreak="event_id"))
    assert "Window" not in p and "Aggregate" in p


def test_split_lag_partitions_by_key_and_bucket(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
        p = plan(W.with_previous(ev, "user_id", "ts", ["ts"], bucket=F.to_date("ts"), tiebreak="event_id"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the big exchange is on (key, bucket); nothing is gathered into one partition
    assert re.search(r"Exchange hashpartitioning\(__kv0#\d+, __kn0#\d+, __b#\d+", p)
    assert "SinglePartition" not in p
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
