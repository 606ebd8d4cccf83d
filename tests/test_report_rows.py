"""Reports on literal rows written from the definitions, and the operators behind them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators import windows as W
from kerbside.plans import cases as PC
from kerbside.plans import sites as PS
from kerbside.plans import visits as PV
from kerbside.plans.dimension import newest_names, site_dimension, with_site, key_parts

t = dt.datetime
LOG = "key string, timestamp timestamp_ntz, type string, action_type string, organization string, parent string, group_id string, name string"


@pytest.fixture(scope="module")
def log(spark):
    rows = [("o#r#a", t(2024, 1, 1), "site", "GroupCreated", "o", "r", "a", "Old"), ("o#r#a", t(2024, 3, 1), "site", "GroupUpdated", "o", "r", "a", "New"),
            ("o#r#a", t(2024, 4, 1), "zone", "GroupUpdated", "o", "r", "a", "Zone"),
            ("o#r#b", t(2024, 1, 1), "site", "GroupCreated", "o", "r", "b", "Gone"), ("o#r#b", t(2024, 2, 1), "site", "GroupDeleted", "o", "r", "b", "Gone"),
            ("o#q#c", t(2024, 1, 1), "site", "GroupCreated", "o", "q", "c", "New")]
    return spark.createDataFrame(rows, LOG)


def test_site_dimension_now_and_then(log):
    now = {(r.group_id, r.name) for r in site_dimension(log).collect()}
    assert now == {("a", "New"), ("c", "New")}
    then = {(r.group_id, r.name) for r in site_dimension(log, at=t(2024, 1, 15)).collect()}
    assert then == {("a", "Old"), ("b", "Gone"), ("c", "New")}
    assert {(r.group_id, r.site_name) for r in newest_names(log).collect()} == {("a", "Zone"), ("b", "Gone"), ("c", "New")}


def test_with_site_left_and_inner(spark, log):
    df = spark.createDataFrame([("o#r#a",), ("o#r#b",), ("o",), (None,)], "k string")
    left = {(r.k, r.site_name) for r in with_site(df, site_dimension(log), key_parts("k")).collect()}
    assert left == {("o#r#a", "New"), ("o#r#b", None), ("o", None), (None, None)}
    assert with_site(df, site_dimension(log), key_parts("k"), how="inner").count() == 1


def test_vehicle_without_a_colour_stays(spark, log):
    cols = "ors_id string, in_plate string, out_plate string, updated timestamp_ntz, rev_id int, arrival timestamp_ntz, departure timestamp_ntz, " \
           "c1 string, c2 string, m1 string, m2 string, f1 string, f2 string, w1 int, w2 int"
    a, d, u = t(2024, 1, 5, 10), t(2024, 1, 5, 10, 30), t(2024, 1, 5, 12)
    rows = [("o#r#a", " ", "P1", u, 1, a, d, " ", None, "m", None, None, "f", None, 7),       # no colour: stays
            ("o#r#a", "P2", "P2", u, 2, a, None, "red", None, "m", None, " ", None, 1, 2),    # no fuel: goes
            ("o#r#a", "P3", "P3", u, 3, a, d, "red", None, "m", None, "f", None, 1, 2),       # its newest visit has no model: goes
            ("o#r#a", "P3", "P3", t(2024, 1, 6), 4, t(2024, 1, 6), d, "red", None, "", " ", "f", None, 1, 2),
            ("o#r#a", "P4", "P4", u, 5, t(2023, 12, 31), d, "red", None, "m", None, "f", None, 1, 2)]  # before the period
    got = PV.vehicle_profile(spark.createDataFrame(rows, cols), {"colour": ("c1", "c2"), "model": ("m1", "m2"), "fuel": ("f1", "f2"), "weight": ("w1", "w2")},
                             ("model", "fuel"), site_dimension(log), "20240101", "20240131", "Europe/Copenhagen").collect()
    assert [(r.plate_no, r.colour, r.model, r.fuel, r.weight, r.stay_minutes, r.site_name, r.update_time) for r in got] == \
        [("P1", None, "m", "f", 7, 30.0, "New", t(2024, 1, 5, 13))]


CASE = "id int, rev int, state string, substate string, organization string, fact_ts timestamp_ntz, " \
       "groups array<struct<type:string,group_ref:string,name:string>>, offenses array<struct<offense_time:timestamp_ntz>>, " \
       "breaches array<struct<ticket_id:int,fees:array<struct<amount:double,source:string,type:string>>>>"


def case(i, rev, state, sub, ref, offences, tickets, fact=t(2024, 1, 1), fees=((10.0, "base", "parking"),), name="n"):
    return (i, rev, state, sub, "o", fact, [("site", ref, name), ("zone", "Z", "z")], None if offences is None else [(x,) for x in offences],
            [(k, [tuple(f) for f in fees]) for k in tickets])


def test_monthly_figures_by_offence_time(spark, log):
    """Month and period of the offence, rows by offence, previous month by site name."""
    rows = [case(1, 0, "Closed", "Paid_Online", "o#r#a", [t(2024, 1, 31, 23, 30)], [1, 2]),           # local February
            case(2, 0, "Open", "nip", "o#r#a", [t(2024, 1, 5), t(2024, 1, 6)], [3]),                  # two offences: cancelled twice
            case(3, 0, "Open", "nip", "o#q#c", [t(2024, 2, 2)], [4, None]),                           # the same name under another parent
            case(4, 0, "Open", "nip", "o#r#a", [t(2024, 3, 1)], [9]), case(5, 0, "Open", "nip", "o#r#a", None, [10]),
            case(6, 0, "Open", "nip", "o#r#b", [t(2024, 1, 5)], [11])]                                # a deleted site
    got = sorted((r.month, r.parent, r.site_name, r.notices, r.paid, r.cancelled, r.prev_notices) for r in PC.monthly_offence_kpi(
        spark.createDataFrame(rows, CASE), site_dimension(log), "20240101", "20240229", "Europe/Copenhagen").collect())
    assert got == [("2024-01", "r", "New", 1, 0, 2, None), ("2024-02", "q", "New", 1, 0, 1, 1), ("2024-02", "r", "New", 2, 2, 0, 1)]


def test_reconcile_keeps_lines_on_two_sites(spark, log):
    late, other = (5.0, "late", "late"), (7.0, "manual", "parking")
    rows = [case(1, 0, "Closed", "s", "o#r#a", None, [1], t(2024, 1, 1), [(10.0, "base", "parking"), late, other]),
            case(1, 1, "Closed", "s2", "o#r#a", None, [1], t(2024, 1, 2), [(20.0, "base", "parking"), late]),     # newer fact of the same group
            case(2, 0, "closed", "s", "o#r#a", None, [2]), case(3, 0, "Closed", "s", "o#r#b", None, [3]),         # not closed as written; no site
            case(4, 0, "Closed", "s", "o#r#a", None, [4], fees=[late]), case(5, 0, "Closed", "s", "o#q#c", None, [5])]
    lines = [(1, "S1", t(2024, 1, 5), 1, 3.0), (1, "S1", t(2024, 1, 6), 1, 4.0), (1, "S2", t(2024, 1, 4), 1, 6.0), (1, "S3", t(2023, 12, 31), 1, 9.0),
             (2, "S1", t(2024, 1, 5), 2, 1.0), (3, "S1", t(2024, 1, 5), 3, 1.0), (4, "S1", t(2024, 1, 5), 4, 1.0)]
    c = spark.createDataFrame(rows, CASE)
    led = spark.createDataFrame(lines, "ticket_id int, site string, time timestamp_ntz, breach_id int, debit double")
    got = PC.reconcile(c, led, site_dimension(log), "Europe/Copenhagen", "20240101", newest_line_only=True).collect()
    assert sorted((r.ticket_id, r.fee_amount, r.substate, r.site_name, r.line_time) for r in got) == \
        [(1, 20.0, "s2", "New", t(2024, 1, 4)), (1, 20.0, "s2", "New", t(2024, 1, 6))]
    got = PC.reconcile(c, led, site_dimension(log), "Europe/Copenhagen", "20240101").collect()
    assert sorted((r.ticket_id, r.debit) for r in got) == [(1, 3.0), (1, 4.0), (1, 6.0), (5, 0.0)]


@pytest.mark.parametrize("newest", [True, False])
def test_reconciled_rows_are_dealt_by_rows(spark, log, monkeypatch, newest):
    """However few bytes they take, no task gets many of the rows."""
    from kerbside.operators import ranges as R
    monkeypatch.setattr(R, "TASK_ROWS", 100)
    c = spark.createDataFrame([case(k, 0, "Closed", "s", "o#r#a", None, [k]) for k in range(800)], CASE)
    led = spark.createDataFrame([(k, "S1", t(2024, 1, 5), k, 3.0) for k in range(800)] + [(None, "S1", t(2024, 1, 5), 1, 3.0)],
                                "ticket_id int, site string, time timestamp_ntz, breach_id int, debit double")
    got = PC.reconcile(c, led, site_dimension(log), "Europe/Copenhagen", "20240101", newest_line_only=newest)
    per = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 800 and max(per) < 200


def test_sites_without_breach_by_gaps(spark):
    day = dt.date
    sites = spark.createDataFrame([("a",), ("never",), ("all",), ("a",)], "site string")
    hits = [("a", day(2024, 1, 2)), ("a", day(2024, 1, 2)), ("a", day(2024, 1, 4)), ("a", day(2023, 12, 31)), ("other", day(2024, 1, 1)), (None, day(2024, 1, 1))]
    hits += [("all", day(2024, 1, i)) for i in range(1, 6)]
    got = PS.sites_without(spark.createDataFrame(hits, "site string, day date"), sites, "site", "day", "20240101", "20240105").collect()
    assert sorted((r.site, r.day.day) for r in got) == [("a", 1), ("a", 3), ("a", 5)] + [("never", i) for i in range(1, 6)]


def test_site_metrics_measures_are_all_there(spark):
    import __spark_entry__ as E
    rows = E.queries()["site_metrics"](spark, "/root/testdata/sf0.01").collect()
    for m in ("footfall", "raw_footfall", "visits", "pcn_count", "potential_revenue", "realised_revenue", "paid_count", "cancelled_count", "appeals_count",
              "debt_count", "debt_receipts"):
        assert any(r[m] for r in rows), m
    assert {r.site_status for r in rows} >= {"Active", "Pending", "Stopped"} and any(r.day is None for r in rows)


@pytest.mark.parametrize("limit", [20, 100, None])
def test_exact_percentiles(spark, limit):
    r = random.Random(2)
    data = [("hot", r.choice([None, r.random(), 0.5])) for _ in range(300)] + [(k, r.random()) for k in "abc" for _ in range(9)] + \
        [("none", None)] * 30 + [(None, float(i)) for i in range(40)]
    df = spark.createDataFrame(data, "k string, v double")
    got = W.exact_percentiles(df, "k", "v", (0.0, 0.05, 0.5, 0.95, 1.0), "abcde", limit=limit)
    want = df.groupBy("k").agg(*[F.percentile("v", p).alias(n) for p, n in zip((0.0, 0.05, 0.5, 0.95, 1.0), "abcde")])
    key = lambda x: (str(x[0]), [None if v is None else round(v, 12) for v in x[1:]])
    assert sorted(map(key, got.collect()), key=str) == sorted(map(key, want.collect()), key=str)


def test_frames_deletions_days_and_long_stays(spark):
    cols = "visit_id int, rev_id int, updated timestamp_ntz, ors_id string, arrival timestamp_ntz, departure timestamp_ntz, action string"
    u = t(2024, 1, 9)
    rows = [(1, 1, u, "o#r#a", t(2024, 1, 5, 23, 30), t(2024, 1, 6, 0, 0, 45), "upsert"),       # local day is the 6th
            (2, 2, u, "o#r#a", t(2024, 1, 6), None, "upsert"), (2, 3, t(2024, 1, 8), "o#r#a", None, t(2024, 1, 1), "upsert"),
            (3, 4, u, "o#r#a", t(2024, 1, 6), None, "upsert"), (3, 5, t(2024, 1, 1), "o#r#a", None, None, "Deleted"),  # any deleted revision
            (4, 6, u, "o#r#a", t(2024, 1, 6), t(2024, 1, 20), "upsert"),                         # longer than 10,000 minutes
            (5, 7, u, "o#r#a", None, t(2024, 1, 7, 5), "upsert"), (6, 8, u, "o#r#a", t(2024, 2, 6), None, "upsert"), (7, 9, None, "o#r#a", t(2024, 1, 6), None, "upsert")]
    zones = spark.createDataFrame([("o", "Europe/Copenhagen")], "org string, timezone string")
    got = PC.stay_frames(spark.createDataFrame(rows, cols), zones, "20240101", "20240131").orderBy("frame_id").collect()
    assert [(r.frame_id, r.day.day, r.hour, r.stay, r.arrivals, r.departures, r.stay_minutes) for r in got] == \
        [("1", 6, 0, 1, 1, 1, 30.8), ("2", 6, 1, 0, 1, 0, 0.0), ("5", 7, 6, 0, 0, 1, 0.0)]


def test_image_gaps_keep_rows(spark, log):
    reads = [(1, "c1", "A", t(2024, 1, 2)), (2, "c1", "8", t(2024, 1, 2)), (3, "c0", "5", t(2024, 1, 2)), (4, "c1", "zz", t(2024, 1, 2)), (5, "c1", "1", t(2024, 3, 2)),
             (6, "c9", "3", t(2024, 1, 2))]
    dev = [("c1", t(2024, 1, 1), "mav-camera", "DeviceUpdated", "One", ["o#r#a", "o#r#b"]), ("c0", t(2024, 1, 1), "mav-camera", "DeviceUpdated", "Null", ["o#q#c"]),
           ("c9", t(2024, 1, 1), "mav-camera", "DeviceUpdated", "Nine", ["o#r#a"]), ("c9", t(2024, 1, 2), "mav-camera", "DeviceDeleted", "Nine", ["o#r#a"])]
    devices = PS.current_devices(spark.createDataFrame(dev, "device_id string, timestamp timestamp_ntz, device_type string, action_type string, name string, group_keys array<string>"))
    got = PS.image_gaps(spark.createDataFrame(reads, "event_id int, device_id string, seq_hex string, ts timestamp_ntz"), devices, site_dimension(log),
                        "20240101", "20240131", "Europe/London").collect()
    # one order over all devices: the first image of c1 is compared with the last of c0; c1 stands at one current site
    assert sorted((r.event_id, r.camera_name, r.site_name, r.seq, r.difference) for r in got) == \
        [(1, "One", "New", 10, 5), (2, "One", "New", 8, -2), (3, "Null", "New", 5, None), (4, "One", "New", None, None)]


def test_consolidated_payments(spark):
    from kerbside.plans.permits import consolidated_payments
    cols = "org string, region string, site string, plate string, request_time timestamp_ntz, transaction_id int, source string, start_time timestamp_ntz, " \
           "end_time timestamp_ntz, amount double, duration_seconds long"
    rows = [("o", "r", "s", "P", t(2024, 1, 1), 1, "app", t(2024, 1, 1), t(2024, 1, 8), 1.0, 60), ("o", "r", "s", "P", t(2024, 1, 1), 1, "app", t(2024, 1, 8), t(2024, 1, 15), 2.0, 120),
            ("o", "r", "s", "P", t(2024, 1, 2), 2, "app", t(2024, 1, 1), t(2024, 1, 15), 9.0, 60), ("o", "r", "s", "P", t(2024, 1, 2), 3, "app", t(2010, 1, 1), t(2010, 1, 2), 5.0, 60)]
    got = consolidated_payments(spark.createDataFrame(rows, cols), "20110101").collect()
    assert [(r.transaction_id, r.amount, r.duration) for r in got] == [(2, 9.0, 1.0)]
    got = consolidated_payments(spark.createDataFrame(rows[:2], cols), "20110101").collect()
    assert [(r.start_time, r.end_time, r.amount, r.duration) for r in got] == [(t(2024, 1, 1), t(2024, 1, 15), 3.0, 3.0)]


def test_period_visits_count_and_previous(spark):
    rows = [(1, "s", "v", t(2024, 1, 1)), (2, "s", "v", t(2024, 1, 20)), (3, "q", "v", t(2024, 1, 25)), (4, "s", "v", t(2024, 2, 25)), (5, "s", "v", t(2023, 12, 30))]
    df = spark.createDataFrame(rows, "k int, site string, vehicle string, ts timestamp_ntz").withColumn("day", F.to_date("ts"))
    got = PV.period_visits(df, "day", "ts", {"now": (dt.date(2024, 1, 1), dt.date(2024, 3, 1))}, "site", "vehicle", "k").orderBy("k").collect()
    # rank over all sites, newest first, plus one if the site saw it within 30 days; the period's start is a border
    assert [(r.k, r.prev_ts, r.entry_count) for r in got] == [(1, None, 4), (2, t(2024, 1, 1), 4), (3, None, 2), (4, t(2024, 1, 20), 1)]


VISITS = ("visit_id int, rev_id int, ors_id string, in_plate string, out_plate string, in_colour string, out_colour string, arrival timestamp_ntz, "
          "departure timestamp_ntz, updated timestamp_ntz, action string")


def test_visit_fact_with_sites(spark, log):
    """Equal visits of different ids are one; a site of the registry gives name, zone and local times; others keep NULLs."""
    at, zones = t(2024, 1, 5, 10), spark.createDataFrame([("o", "Europe/Berlin")], "org string, timezone string")
    rows = [(i, i, "o#r#a", "P", None, None, "red", at, at + dt.timedelta(minutes=30), at, "upsert") for i in (1, 2)]
    rows += [(3, 3, "o#r#a", "P", None, "blue", "red", at, None, at, "upsert"), (4, 4, "o#r#x", "Q", None, None, None, at, at, at, "upsert"),
             (5, 5, "o#r#a", "R", None, None, None, at, at, at, "deleted"), (6, 6, None, None, None, None, None, at, at, at, "upsert")]
    permits = spark.createDataFrame([("o", "r", "a", "P", t(2024, 1, 1), None, None)] * 3,
                                    "org string, region string, site string, plate string, start_time timestamp_ntz, "
                                    "response_time timestamp_ntz, end_time timestamp_ntz")
    out = PV.visit_fact_with_sites(spark.createDataFrame(rows, VISITS), permits, site_dimension(log, zones=zones), {"colour": ("in_colour", "out_colour")})
    got = sorted(map(tuple, out.select("site_name", "plate", "colour", "entry_time", "stay_minutes", "is_whitelisted", "visits").collect()), key=str)
    here = t(2024, 1, 5, 11)
    assert got == sorted([("New", "P", "red", here, 30.0, True, 1), ("New", "P", "blue", here, None, True, 1),
                          (None, "Q", None, None, None, False, 1), (None, None, None, None, None, False, 1)], key=str)


def test_hourly_visits(spark, log):
    """Newest revision in the period by local day; out counts in the entry hour only; sites without a row or of other names go."""
    zones = spark.createDataFrame([("o", "Europe/Berlin")], "org string, timezone string")
    sites = site_dimension(log, zones=zones).withColumn("bays", F.lit(7))
    late = t(2024, 1, 4, 23, 30)  # the 5th in Berlin
    rows = [(1, 1, "o#r#a", "P", "P", None, None, late, late + dt.timedelta(minutes=20), late, "upsert"),
            (1, 2, "o#r#a", "P", "P", None, None, t(2024, 1, 9), None, late + dt.timedelta(hours=1), "upsert"),  # newer, but outside
            (2, 3, "o#r#a", "Q", "Q", None, None, t(2024, 1, 5, 10, 50), t(2024, 1, 5, 12, 1, 30), late, "upsert"),
            (3, 4, "o#r#a", None, "S", None, None, t(2024, 1, 5, 9), None, late, "upsert"), (4, 5, "o#r#b", "T", "T", None, None, t(2024, 1, 5, 9), None, late, "upsert")]
    v = spark.createDataFrame(rows, VISITS)
    got = sorted(map(tuple, PV.hourly_visits(v, sites, "20240105", "20240105").select(
        "site_name", "bays", "hour", "stay_clock", "vehicles_in", "vehicles_out").collect()), key=str)
    assert got == sorted([("New", 7, t(2024, 1, 5), t(2024, 1, 5, 0, 20), 1, 1), ("New", 7, t(2024, 1, 5, 11), t(2024, 1, 5, 1, 11), 1, 0),
                          ("New", 7, t(2024, 1, 5, 10), None, 0, 0)], key=str)
    assert PV.hourly_visits(v, sites, "20240105", "20240105", names=["Other"]).count() == 0


def test_breach_states(spark):
    """Newest fact of a ticket in the period decides; closed errors and closed ones without a sub-state go; a site without a breach has 0."""
    day = t(2024, 1, 5, 23, 30)  # the 6th in Berlin
    rows = [(1, 10, "o", "r", "a", day, day, "Open", None), (2, 10, "o", "r", "a", day + dt.timedelta(hours=1), day, "Closed", "paid"),
            (3, 11, "o", "r", "a", day, day, "Closed", "nip"), (4, 12, "o", "r", "a", day, day, "Open", "nip"), (5, 13, "o", "r", "a", day, day, "Closed", None),
            (6, 14, "o", "r", "a", day, t(2024, 1, 7, 23, 30), "Open", None), (7, None, "o", "r", "a", day, day, "Open", None), (8, 15, "o", "r", "z", day, day, "Open", None)]
    facts = spark.createDataFrame(rows, "event_id int, breach_id int, org string, region string, site string, fact_ts timestamp_ntz, "
                                        "offense_time timestamp_ntz, state string, substate string")
    sites = spark.createDataFrame([("o#r#a", "A", "7", "Active"), ("o#r#b", "B", None, None)], "site_ref string, site_name string, site_code string, site_status string")
    zones = spark.createDataFrame([("o", "Europe/Berlin")], "org string, timezone string")
    got = sorted(map(tuple, PS.breach_states(facts, sites, zones, "20240106", "20240107").collect()), key=str)
    d = dt.date(2024, 1, 6)
    assert got == sorted([("o#r#a", "A", "7", "Active", "Closed", d, 1, "10"), ("o#r#a", "A", "7", "Active", "Open", d, 1, "12"),
                          ("o#r#b", "B", None, None, None, None, 0, None)], key=str)
