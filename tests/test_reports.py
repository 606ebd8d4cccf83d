"""Invariants of the registered reports (SURVEY §5 (3)), on the sf0.001 tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E

from .conftest import SF_SMALL


def q(spark, key):
    return E.queries()[key](spark, SF_SMALL)


def test_latest_by_key_one_row_per_key(spark):
    df = q(spark, "latest_by_key")
    assert df.count() == df.select("visit_id").distinct().count()


def test_weekday_grid_is_complete(spark):
    df = q(spark, "weekday_grid")
    sites = df.select("site").distinct().count()
    assert df.count() == 14 * sites
    assert df.select("label").distinct().count() == 14


def test_daily_reset_starts_each_day_from_zero(spark):
    df = q(spark, "occupancy_daily_reset").withColumn("d", F.to_date("slot"))
    w = Window.partitionBy("ors_id", "d").orderBy("slot")
    first = df.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    assert first.where(F.col("occupancy") != F.col("entries") - F.col("exits")).count() == 0


def test_running_occupancy_grid_size(spark):
    df = q(spark, "occupancy_running")
    sites = df.select("ors_id").distinct().count()
    assert df.count() == sites * 2 * 96


def test_stays_respect_the_cap(spark):
    assert q(spark, "stay_duration").where(F.col("stay_minutes") > 300).count() == 0


def test_backlog_forms_agree_on_daily_counts(spark):
    a = {r.day: (r.opened, r.resolved) for r in q(spark, "status_backlog_opening").collect()}
    b = {r.day: (r.opened, r.resolved) for r in q(spark, "status_backlog_distinct").collect()}
    assert all(b[d] == a[d] for d in a if d in b)


def test_hourly_share_is_capped(spark):
    df = q(spark, "occupancy_share")
    assert df.where((F.col("occupied_share") > 1) | (F.col("occupied_share") < 0)).count() == 0


def test_spatial_join_keeps_every_point(spark):
    pts = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert q(spark, "spatial_join").count() == pts
