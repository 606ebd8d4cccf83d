"""Literal tables with hand-computed answers for the dialect differences of SURVEY §2.8."""

import datetime as dt

from pyspark.sql import functions as F

from kerbside.functions import timefn as T
from kerbside.functions import values as V


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_least_greatest_null_guard(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (3, None)], "a int, b int")
    got = df.select(V.least_strict("a", "b").alias("lo"), V.greatest_strict("a", "b").alias("hi")).collect()
    assert [(r.lo, r.hi) for r in got] == [(1, 5), (None, None), (None, None)]


def test_boundary_versus_elapsed(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:59:00"), ts("2024-01-01 01:01:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(T.boundaries("hour", "a", "b").alias("bd"), T.elapsed("hour", "a", "b").alias("el"),
                  T.boundaries("day", "a", "b").alias("dd")).first()
    assert (r.bd, r.el, r.dd) == (1, 0, 0)


def test_week_numbers_sunday_and_monday(spark):
    # 2023-01-01 is a Sunday; 2024-01-01 a Monday
    days = [dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 7), dt.date(2023, 1, 8),
            dt.date(2024, 1, 1), dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [(r.s, r.m) for r in df.select(T.week_sunday("d").alias("s"), T.week_monday("d").alias("m")).collect()]
    assert got == [(1, 0), (1, 1), (1, 1), (2, 1), (0, 1), (0, 1), (1, 1), (1, 2)]


def test_contains_substr_ignores_case(spark):
    df = spark.createDataFrame([("BreachError",), ("ok",)], "s string")
    assert [r.c for r in df.select(V.contains_ci("s", "breacherror").alias("c")).collect()] == [True, False]


def test_json_extract_keeps_quotes(spark):
    df = spark.createDataFrame([('{"a": "x", "n": 5, "l": [1, 2]}',)], "j string")
    r = df.select(V.json_raw("j", "$.a").alias("a"), V.json_raw("j", "$.n").alias("n"),
                  V.json_raw("j", "$.l").alias("l"), V.json_text("j", "$.a").alias("t")).first()
    assert (r.a, r.n, r.l, r.t) == ('"x"', "5", "[1,2]", "x")


def test_hex_safe_cast(spark):
    df = spark.createDataFrame([("ff",), ("zz",), ("10",)], "h string")
    assert [r.v for r in df.select(V.hex_to_long("h").alias("v")).collect()] == [255, None, 16]


def test_key_part_out_of_range_is_null(spark):
    df = spark.createDataFrame([("a#b#c",), ("a#b",)], "k string")
    got = df.select(V.key_part("k", 2).alias("s")).collect()
    assert [r.s for r in got] == ["c", None]


def test_local_day_versus_utc_day(spark):
    # 11:30 UTC on Jan 1 is Jan 2 in Auckland (+13)
    df = spark.createDataFrame([(ts("2024-01-01 11:30:00"),)], "t timestamp_ntz")
    r = df.select(T.local_date("t").alias("u"), T.local_date("t", "Pacific/Auckland").alias("l")).first()
    assert (r.u, r.l) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert df.where(T.between_local_days("t", "Pacific/Auckland", "20240102", "20240102")).count() == 1


def test_local_time_null_zone(spark):
    df = spark.createDataFrame([(ts("2024-06-01 10:00:00"), None), (ts("2024-06-01 10:00:00"), "Europe/London")],
                               "t timestamp_ntz, z string")
    got = [r.l for r in df.select(T.local_time("t", F.col("z")).alias("l")).collect()]
    assert got == [None, ts("2024-06-01 11:00:00")]


def test_recode_keeps_unknown(spark):
    df = spark.createDataFrame([("PAID",), ("paid_online",), ("other",)], "s string")
    got = [r.x for r in df.select(V.recode("s", {"PaidOnline": ["paid", "paid_online"]}).alias("x")).collect()]
    assert got == ["PaidOnline", "PaidOnline", "other"]


def test_stay_minutes_rounding(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:00:00"), ts("2024-01-01 10:06:33")),
                                (ts("2024-01-01 10:00:00"), None)], "a timestamp_ntz, d timestamp_ntz")
    assert [r.m for r in df.select(T.stay_minutes("a", "d").alias("m")).collect()] == [6.6, 0.0]


def test_bucket_floor(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:29:59"),)], "t timestamp_ntz")
    assert df.select(T.bucket_floor("t", 900).alias("b")).first().b == ts("2024-01-01 10:15:00")


def test_permit_normalise_key_end_and_seconds(spark):
    from kerbside.plans.visits import normalise_permits
    s, resp = ts("2024-01-01 10:00:00.700"), ts("2024-01-01 10:00:05.900")
    df = spark.createDataFrame(
        [("o", "r", "s", "P1", s, resp, None), ("o", "r", "s", "P1", s, None, ts("2099-02-01 00:00:00")),
         ("o", None, "s", "P2", s, resp, ts("2024-02-01 00:00:00.500"))],
        "org string, region string, site string, plate string, start_time timestamp_ntz, response_time timestamp_ntz, end_time timestamp_ntz")
    a, b, c = normalise_permits(df).select("valid_from", "valid_to", "permit_hash").collect()
    far = dt.datetime(9999, 12, 31)
    assert (a.valid_from, a.valid_to) == (ts("2024-01-01 10:00:05"), far)
    assert (b.valid_from, b.valid_to) == (ts("2024-01-01 10:00:00"), far)
    assert (c.valid_to, c.permit_hash) == (ts("2024-02-01 00:00:00"), None)
    assert a.permit_hash == b.permit_hash is not None


def test_whitelist_needs_the_same_site(spark):
    from kerbside.plans.visits import build_visit_fact
    at = ts("2024-01-05 10:00:00")
    visits = spark.createDataFrame(
        [(1, 1, "o#r#s1", "P", "P", at, None, at, "upsert"), (2, 2, "o#r#s2", "P", "P", at, at + dt.timedelta(minutes=3), at, "upsert"),
         (2, 3, "o#r#s2", "P", "P", at, at, at + dt.timedelta(hours=1), "upsert")],
        "visit_id int, rev_id int, ors_id string, in_plate string, out_plate string, arrival timestamp_ntz, "
        "departure timestamp_ntz, updated timestamp_ntz, action string")
    permits = spark.createDataFrame([("o", "r", "s2", "P", ts("2024-01-01 00:00:00"), None, None)] * 2,
                                    "org string, region string, site string, plate string, start_time timestamp_ntz, "
                                    "response_time timestamp_ntz, end_time timestamp_ntz")
    tz = spark.createDataFrame([("o", "Europe/London")], "org string, timezone string")
    got = {r.visit_id: (r.is_whitelisted, r.stay_minutes) for r in build_visit_fact(visits, permits, tz).collect()}
    assert got == {1: (False, None), 2: (True, 3.0)}


def test_compliance_start_inside_period_keeps_every_plate(spark):
    from kerbside.plans.permits import compliance
    day = lambda m, d: dt.datetime(2024, m, d)
    pay = spark.createDataFrame(
        [(1, "o", "r", "s", p, day(3, 1), day(3, 8), 600, 5.0, 9.0, day(3, 1), "app#x") for p in ("A", "B")]
        + [(1, "o", "r", "s", "A", day(3, 8), day(3, 15), 600, 5.0, 9.0, day(3, 1), "app#x"),
           (2, "o", "r", "s", "C", day(1, 1), day(12, 1), 600, 5.0, 9.0, day(1, 1), "app#x")],
        "transaction_id bigint, org string, region string, site string, plate string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "duration_seconds bigint, amount double, total_amount double, request_time timestamp_ntz, source string")
    permits = spark.createDataFrame(
        [(i, "o", "r", "s", "K", day(3, 2), day(3, 9), 1.0, day(3, 2), "permit", src) for i, src in
         ((1, "web"), (1, "web"), (2, "o#r#s#cam"), (3, None))],
        "permit_id bigint, org string, region string, site string, plate string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "amount double, request_time timestamp_ntz, kind string, permit_source string")
    got = compliance(permits, pay, "o", "r", "s", "20240301", "20240331", "UTC").collect()
    assert sorted((r.record_type, r.plate, r.end_local, r.total_amount, r.duration, r.source) for r in got if r.total_amount) == [
        ("payment", "A", day(3, 15), 9.0, 20.0, "app"), ("payment", "B", day(3, 8), 9.0, 10.0, "app")]
    assert [(r.plate, r.permit_id) for r in got if r.record_type == "permit"] == [("K", "1")]


def test_case_totals_repeat_on_each_breach(spark):
    from kerbside.plans.cases import case_financials
    b = "array<struct<ticket_id:int,fees:array<struct<amount:double>>,transactions:array<struct<amount:double>>>>"
    t = ts("2024-01-05 10:00:00")
    df = spark.createDataFrame([(1, 1, t, t, "UTC", t, t, [(1, [(10.0,)], None), (2, [(20.0,)], [(4.0,)]), (None, None, None)])],
                               "id int, rev int, fact_ts timestamp_ntz, case_ts timestamp_ntz, timezone string, "
                               f"arrival timestamp_ntz, departure timestamp_ntz, breaches {b}")
    got = [(r.ticket_id, r.fees, r.receipts) for r in case_financials(df, "20240101", "20240131").collect()]
    assert sorted(got) == [(1, 30.0, 4.0), (2, 30.0, 4.0)]


def test_overnight_exit_stands_on_the_departure_day(spark):
    from kerbside.plans.occupancy import split_overnight
    df = spark.createDataFrame([(1, ts("2024-01-01 22:10:00"), ts("2024-01-04 06:50:00")), (2, ts("2024-01-01 22:10:00"), None),
                                (3, ts("2024-01-01 08:10:00"), ts("2024-01-01 09:20:00"))],
                               "id int, a timestamp_ntz, d timestamp_ntz")
    got = {(r.id, r.part): (str(r.day), r.entry_hour and r.entry_hour.hour, r.exit_hour and r.exit_hour.hour)
           for r in split_overnight(df, "a", "d", "UTC", ["id"]).collect()}
    assert got == {(1, "entry"): ("2024-01-01", 22, None), (1, "exit"): ("2024-01-04", None, 6),
                   (2, "entry"): ("2024-01-01", 22, None), (3, "entry"): ("2024-01-01", 8, 9)}


def test_slots_of_short_and_long_days(spark):
    from kerbside.plans.occupancy import slot_grid
    ent = spark.createDataFrame([("a", "Europe/London"), ("b", "Asia/Tokyo"), ("c", None)], "site string, tz string")
    count = lambda day: {r.site: r["count"] for r in
                         slot_grid(ent, day, day, 15, tz=F.col("tz")).groupBy("site").count().collect()}
    assert count("20240331") == {"a": 92, "b": 96}
    assert count("20241027") == {"a": 96, "b": 96}


def test_mail_label_rule_and_local_day(spark):
    from kerbside.plans.backlog import mail_transitions
    rows = [(1, "u", "2024-01-05 20:00:00", '{"mailUpdate": {"labels": {"Unresolved": "true"}}}'),
            (2, "u", "2024-01-06 01:00:00", '{"mailUpdate": {"labels": {"Resolved": "true", "Unresolved": "false"}}}'),
            (3, "u", "2024-01-07 01:00:00", '{"mailUpdate": {"labels": {"Resolved": "false", "Unresolved": "true"}}}'),
            (4, "v", "2024-01-06 01:00:00", '{"mailUpdate": {"labels": {"Linked": "true"}}}'),
            (5, "w", "2024-01-06 01:00:00", '{"label": "Resolved"}')]
    df = spark.createDataFrame([(i, u, ts(t), d, '{"name": "n%d"}' % i) for i, u, t, d in rows],
                               "event_id int, uri string, ts timestamp_ntz, data string, user_json string")
    got = mail_transitions(df, "uri", "ts", "data", "user_json", "Pacific/Auckland", tiebreak="event_id").collect()
    assert sorted((str(r.day), r.uri, r.user_name, r.unresolved_count, r.resolved_count) for r in got) == [
        ("2024-01-06", "u", "n1", 1, 0), ("2024-01-06", "u", "n2", 0, 1)]


def test_resolution_keeps_pairs_and_final_author(spark):
    from kerbside.plans.backlog import resolution_pairs, resolution_times
    df = spark.createDataFrame([(i, "c", ts(f"2024-01-0{i} 10:00:00"), s, a) for i, s, a in
                                ((1, "Open", "x"), (2, "Pending", "p"), (3, "Open", "y"), (4, "Resolved", "z"), (5, "Open", "q"))],
                               "e int, c string, t timestamp_ntz, s string, a string")
    r = resolution_pairs(resolution_times(df, "c", "t", "s", "a", tiebreak="e"), "s", "a", "Open", "Resolved").collect()
    assert sorted((x.e, x.final_author, x.days_to_next) for x in r) == [(3, "z", 1), (4, "z", 1)]


def test_receipts_debit_lines_and_first_credit(spark):
    from kerbside.plans.cases import credit_receipts, debit_receipts
    rows = [(1, 1, "S", "2024-01-05 10:00:00", 900.0, 0.0), (1, 2, "S", "2024-01-06 10:00:00", 880.0, 900.0),
            (2, 1, "S", "2024-01-05 10:00:00", 10.0, 900.0), (2, 2, "S", "2024-01-07 10:00:00", None, 5.0),
            (3, 1, "S", "2024-01-31 10:00:00", 1000.0, 1000.0), (4, 1, "T", "2024-01-05 10:00:00", 900.0, 900.0)]
    df = spark.createDataFrame([(b, n, s, ts(t), "k", "d", x, y) for b, n, s, t, x, y in rows],
                               "breach_id int, line_no int, site string, time timestamp_ntz, transaction_type string, "
                               "description string, debit double, credit double")
    args = (df, "S", "20240101", "20240131", "UTC")
    got = [(r.breach_id, r.line_no, r.base_fee) for r in debit_receipts(*args, since="20240101").collect()]
    assert sorted(got) == [(1, 1, 875.0), (1, 2, 875.0), (3, 1, 875.0)]
    got = [(r.breach_id, r.line_no, r.amount) for r in credit_receipts(*args, since="20240101").collect()]
    assert got == [(2, 1, 875.0)]  # the end is the midnight that begins the last day


def test_monthly_kpi_per_site(spark):
    from kerbside.plans.cases import monthly_kpi
    g = [("site", "r#s1", "One")]
    t = dt.datetime
    rows = [("Closed", "Paid_Online", t(2024, 1, 5), g, [(1,), (2,)]), ("closed", "paid_online", t(2024, 1, 6), g, [(3,)]),
            ("Open", "nip", t(2024, 1, 31, 23, 30), g, [(4,), (None,)]), ("Open", "nip", t(2024, 1, 5), [("zone", "x", "X")], [(9,)])]
    df = spark.createDataFrame(rows, "state string, substate string, case_ts timestamp_ntz, groups array<struct<type:string,"
                               "group_ref:string,name:string>>, breaches array<struct<ticket_id:int>>")
    got = [(r.month, r.notices, r.paid, r.cancelled, r.prev_notices)
           for r in monthly_kpi(df, "20240101", "20240131", "Europe/Copenhagen").orderBy("month").collect()]
    assert got == [("2024-01", 3, 2, 0, None), ("2024-02", 1, 0, 1, 3)]


def test_weekday_compare_offsets_and_local_day(spark):
    from kerbside.plans.sites import weekday_compare
    rows = [("a", "1998-06-17 10:00:00", 1), ("a", "1998-06-22 23:30:00", 2),  # the local day of 2 is the 23rd
            ("a", "1998-06-09 10:00:00", 3), ("a", "1998-06-16 10:00:00", 3), ("a", "1998-06-16 10:00:00", 4),
            ("b", "1998-06-24 10:00:00", 5), ("c", "1998-06-08 10:00:00", 6)]
    df = spark.createDataFrame(rows, "site string, t string, id int").selectExpr("site", "cast(t as timestamp_ntz) t", "id")
    got = {(r["site"], r["label"]): r["breaches"]
           for r in weekday_compare(df, "site", "t", "id", "19980617", "19980630", "Europe/London").collect()}
    assert len(got) == 14 and {k: v for k, v in got.items() if v} == {
        ("a", "Wednesday"): 1, ("a", "Tuesday"): 1, ("a", "Last Tuesday"): 2}
