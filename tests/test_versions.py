"""Versioned tables: a failed write changes nothing, clustering in several columns, days replaced alone."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.sources import sinks
from kerbside.sources import versions as V


@pytest.fixture()
def path(spark):
    return sinks.scratch_table_path(spark, "versioned")


def rows(df):
    return sorted(map(str, df.collect()))


def test_failed_write_leaves_the_old_table(spark, path):
    old = spark.range(5).withColumn("v", F.lit("a"))
    V.publish(old, path)
    reader = V.read_current(spark, path)
    bad = spark.range(3).withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("stop"))).otherwise("b"))
    with pytest.raises(Exception, match="stop"):
        V.publish(bad, path)
    assert rows(V.read_current(spark, path)) == rows(old)
    V.publish(spark.range(2).withColumn("v", F.lit("c")), path)
    assert V.read_current(spark, path).count() == 2
    assert reader.count() == 5  # a reader keeps the version it opened


def test_no_table(spark, path):
    with pytest.raises(FileNotFoundError):
        V.read_current(spark, path)


def test_schema_descriptions_and_append(spark, path):
    schema = T.StructType([T.StructField("site", T.StringType()), T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType())])
    V.publish(spark.createDataFrame([("s", 1, 9)], "site string, amount int, extra int"), path, schema, comment="what it holds", columns={"amount": "paid"})
    V.add_rows(spark.createDataFrame([(2.5, "t")], "amount double, site string"), path)
    V.add_rows(spark.createDataFrame([("n", "u")], "note string, site string"), path)
    now = V.read_current(spark, path)
    assert sorted(map(tuple, now.collect()), key=str) == [("s", 1.0, None), ("t", 2.5, None), ("u", None, "n")]
    assert now.schema["amount"].metadata["comment"] == "paid" and V.current_paths(spark, path)[2] == "what it holds"


def test_hot_site_spans_files_and_every_column_is_narrow(spark, path):
    r = random.Random(3)
    data = [("hot" if i % 3 == 0 else r.choice([None, "a", "b", "c", "d", "e"]), r.randrange(1000), dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(2000)), "x" * 40)
            for i in range(6000)]
    df = spark.createDataFrame(data, "site string, n int, t timestamp_ntz, pad string").repartition(6)
    V.publish(df, path, cluster_by=["site", "n"], max_file_bytes=30_000)
    got = V.read_current(spark, path).withColumn("f", F.input_file_name())
    assert rows(got.drop("f")) == rows(df)
    files = got.groupBy("f").agg(F.count(F.lit(1)).alias("c"), F.count_distinct("site").alias("sites"), (F.max("n") - F.min("n")).alias("span")).collect()
    assert len(files) >= 16 and max(x["c"] for x in files) < 6000 / len(files) * 3
    assert got.where("site = 'hot'").select("f").distinct().count() > 3
    # a filter on the second column alone leaves out files, too
    assert sum(x["span"] < 700 for x in files) > len(files) / 2
    assert got.where("n < 100").select("f").distinct().count() < len(files) * 0.8


def test_interleaving_of_nothing(spark, path):
    V.publish(spark.createDataFrame([], "a int, b string"), path, cluster_by=["a", "b"])
    assert V.read_current(spark, path).count() == 0
    V.publish(spark.createDataFrame([(None, None)], "a int, b string"), path, cluster_by=["a", "b"])
    assert V.read_current(spark, path).count() == 1


def test_days_replaced_alone(spark, path):
    d = [dt.date(2024, 1, i) for i in range(1, 5)]
    V.publish_days(spark.createDataFrame([(x, i, 0) for x in d[:3] for i in range(4)], "day date, id int, v int"), path, "day")
    before = {f for f in V.read_current(spark, path).select(F.input_file_name()).distinct().toPandas().iloc[:, 0] if "2024-01-02" not in f and "2024-01-03" not in f}
    # day 2 gets new rows, day 3 becomes empty, day 4 is new; a row on day 1 is not among the days given
    new = spark.createDataFrame([(d[1], 9, 1), (d[3], 9, 1), (d[0], 9, 1)], "day date, id int, v int")
    assert V.publish_days(new, path, "day", [d[1], d[2], d[3]]) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    now = V.read_current(spark, path)
    assert sorted(map(tuple, now.collect())) == [(d[0], i, 0) for i in range(4)] + [(d[1], 9, 1), (d[3], 9, 1)]
    assert before and before <= set(now.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert V.publish_days(new, path, "day", []) == []
    V.publish_days(new.where("false"), path, "day", d)
    assert V.read_current(spark, path).count() == 0


def test_visit_fact_refresh_equals_a_full_build(spark, path):
    """New revisions move a visit to another day, add one, and leave a day's files alone."""
    from kerbside.plans import visits as PV
    t = dt.datetime
    cols = "visit_id int, rev_id int, ors_id string, in_plate string, out_plate string, arrival timestamp_ntz, departure timestamp_ntz, updated timestamp_ntz, action string"

    def visit(i, rev, day, updated, action="upsert"):
        return (i, rev, "o#r#s", f"P{i}", None, t(2024, 1, day, 10), t(2024, 1, day, 11), t(2024, 2, 1, updated), action)

    old = [visit(1, 1, 5, 5), visit(2, 2, 6, 5), visit(3, 3, 7, 5), visit(4, 4, 6, 5)]
    added = [visit(1, 5, 8, 1), visit(5, 6, 6, 1), visit(4, 7, 6, 9)]  # an earlier revision of 1 on the 8th
    z = spark.createDataFrame([("o", "Europe/London")], "org string, timezone string")
    e = spark.createDataFrame([], "org string, region string, site string, plate string, start_time timestamp_ntz, end_time timestamp_ntz, response_time timestamp_ntz")
    first, every = spark.createDataFrame(old, cols), spark.createDataFrame(old + added, cols)
    V.publish_days(PV.build_visit_fact(first, e, z, day="day"), path, "day")
    files = {f for f in V.read_current(spark, path).select(F.input_file_name()).distinct().toPandas().iloc[:, 0] if "2024-01-07" in f}
    days = PV.refresh_visit_fact(path, every, spark.createDataFrame(added, cols), e, z)
    now = V.read_current(spark, path)
    assert rows(now) == rows(PV.build_visit_fact(every, e, z, day="day").select(*now.columns))
    assert days == ["2024-01-05", "2024-01-06", "2024-01-08"]
    assert files and files <= set(now.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
