"""Logical inputs of the report family, derived from the driver tables.

The reports run over a vehicle-visit / notice / permit / telemetry data
set.  The test tables are a generic star schema plus an event stream, so
each logical input is a fixed, deterministic column mapping of one or two
driver tables (see FIXTURES.md §2).  Every mapping is plain arithmetic on
the source columns, runs as a narrow projection (no shuffle) except
``cases`` (one group-by of line items per order), and grows with the data.

The DuckDB oracle builds the same rows from the same tables
(``kerbside.suite.oracle_inputs``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.ranges import spread
from kerbside.sources.tables import literal_table, scan

# Fixed values of the test mapping (not reference data).
ORG_TIMEZONES = [
    ("org0", "Europe/London"),
    ("org1", "Europe/Copenhagen"),
    ("org2", "Europe/Berlin"),
    ("org3", "Pacific/Auckland"),
    ("org4", "America/New_York"),
    ("org5", "Australia/Sydney"),
    ("org9", "Asia/Tokyo"),
]

_K = "CAST(get_json_object(props, '$.k') AS BIGINT)"


def _events(spark: SparkSession, base: str) -> DataFrame:
    return scan(spark, base, "events").withColumn("k", F.expr(_K))


def visits(spark: SparkSession, base: str) -> DataFrame:
    """Matched visits: two revisions per visit id, NULL plates/exits, deletes."""
    return _events(spark, base).select(*_visit_columns())


def vehicle_visits(spark: SparkSession, base: str) -> DataFrame:
    """The visits with what the cameras tell of the vehicle: model, year, fuel, weight, CO2."""
    return _events(spark, base).select(
        *_visit_columns(),
        F.expr("CASE WHEN event_id % 6 = 0 THEN '' ELSE concat('mod', user_id % 11) END").alias("in_model"),
        F.expr("CASE WHEN k % 5 = 0 THEN NULL ELSE concat('mod', user_id % 8) END").alias("out_model"),
        F.expr("CASE WHEN k % 3 = 0 THEN 2000 + k % 24 END").alias("in_year"),
        F.expr("CASE WHEN k % 2 = 0 THEN 2001 + k % 20 END").alias("out_year"),
        F.expr("CASE WHEN k % 7 = 0 THEN '  ' ELSE concat('fuel', k % 4) END").alias("in_fuel"),
        F.expr("CASE WHEN k % 2 = 0 THEN NULL ELSE concat('fuel', k % 3) END").alias("out_fuel"),
        F.expr("CASE WHEN k % 6 = 0 THEN NULL ELSE 90 + k % 60 END").alias("in_co2"),
        F.expr("CASE WHEN k % 4 = 1 THEN NULL ELSE 900 + k END").alias("in_weight"),
        F.expr("1000 + k").alias("out_weight"),
    )


def _visit_columns() -> list:
    return [
        F.expr("event_id div 2").alias("visit_id"),
        F.col("event_id").alias("rev_id"),
        F.expr("concat('org', user_id % 7, '#r', k % 5, '#', event_type)").alias("ors_id"),
        F.expr("CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('P', user_id) END").alias("in_plate"),
        F.expr("concat('P', user_id)").alias("out_plate"),
        F.col("ts").alias("arrival"),
        F.expr("CASE WHEN event_id % 11 = 0 THEN NULL "
               "ELSE timestampadd(SECOND, CAST(round(value * 60) AS BIGINT), ts) END").alias("departure"),
        F.expr("timestampadd(SECOND, k, ts)").alias("updated"),
        F.expr("CASE WHEN event_id % 23 = 0 THEN 'deleted' ELSE 'upsert' END").alias("action"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN '  ' ELSE concat('make', user_id % 9) END").alias("in_make"),
        F.expr("concat('make', user_id % 6)").alias("out_make"),
        F.expr("CASE WHEN k % 4 = 0 THEN NULL ELSE concat('c', k % 6) END").alias("in_colour"),
        F.expr("CASE WHEN k % 3 = 0 THEN ' ' ELSE concat('c', k % 5) END").alias("out_colour"),
    ]


def group_log(spark: SparkSession, base: str) -> DataFrame:
    """Action log of the sites that visits and notices stand at (key parts organization, parent, group_id)."""
    e = _events(spark, base).select(
        F.expr("concat('org', user_id % 7)").alias("organization"), F.expr("concat('r', user_id % 5)").alias("parent"),
        F.col("event_type").alias("group_id"), F.col("ts").alias("timestamp"),
        F.expr("CASE WHEN k % 10 = 0 THEN 'zone' ELSE 'site' END").alias("type"),
        F.expr("CASE WHEN event_id % 7 = 0 THEN 'GroupDeleted' ELSE 'GroupUpdated' END").alias("action_type"),
        F.expr("concat('Park ', event_type, ' ', user_id % 5, ' v', event_id % 3)").alias("name"),
        *_place("user_id % 7", "user_id % 5", "length(event_type)"))
    o = scan(spark, base, "orders").select(
        F.expr("concat('org', o_custkey % 7)").alias("organization"), F.expr("concat('r', o_custkey % 5)").alias("parent"),
        F.expr("concat('S', o_custkey % 20)").alias("group_id"),
        F.expr("timestampadd(SECOND, o_orderkey % 86400, o_orderdate)").alias("timestamp"),
        F.expr("CASE WHEN o_orderkey % 10 = 0 THEN 'zone' ELSE 'site' END").alias("type"),
        F.expr("CASE WHEN o_orderkey % 9 = 0 THEN 'GroupDeleted' ELSE 'GroupUpdated' END").alias("action_type"),
        F.expr("concat('Site ', o_custkey % 20, ' v', o_orderkey % 3)").alias("name"),
        *_place("o_custkey % 7", "o_custkey % 5", "o_custkey % 20"))
    return e.unionByName(o).withColumn("key", F.concat_ws("#", "organization", "parent", "group_id"))


def _place(org: str, region: str, group: str) -> list:
    """Longitude and latitude of a site, to both sides of the date line."""
    return [F.expr(f"CAST(({org} * 13 + {region} * 29 + {group} * 7) % 100 AS DOUBLE) / 10 + 175.03D").alias("lon"),
            F.expr(f"CAST(({org} * 31 + {region} * 17 + {group} * 11) % 100 AS DOUBLE) / 10 - 4.99D").alias("lat")]


def area_texts(spark: SparkSession, base: str) -> DataFrame:
    """The polygons as text, moved across the date line."""
    lon = lambda p: F.pmod(p["lon"] + 355, F.lit(360.0)) - 180
    point = lambda p: F.concat_ws(" ", lon(p).cast("string"), (p["lat"] - 5).cast("string"))
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(F.concat(r, F.slice(r, 1, 1)), point), ", "), F.lit(")"))
    return polygons(spark, base).select("n_nationkey", "n_name", F.concat(F.lit("POLYGON("), F.array_join(F.transform("rings", ring), ", "),
                                                                          F.lit(")")).alias("geometry"))


def device_log(spark: SparkSession, base: str) -> DataFrame:
    """Action log of the cameras: newest row per camera, some deleted, each at one or two sites."""
    ref = "concat('org', user_id % 7, '#r', user_id % 5, '#', event_type)"
    return _events(spark, base).select(
        F.expr("concat('cam', user_id % 12)").alias("device_id"), F.col("ts").alias("timestamp"),
        F.expr("CASE WHEN k % 6 = 0 THEN 'relay' ELSE 'mav-camera' END").alias("device_type"),
        F.expr("CASE WHEN event_id % 8 = 0 THEN 'DeviceDeleted' ELSE 'DeviceUpdated' END").alias("action_type"),
        F.expr("concat('Camera ', user_id % 12, ' v', event_id % 3)").alias("name"),
        F.expr(f"CASE WHEN k % 2 = 0 THEN array({ref}, 'org0#r0#view') ELSE array({ref}) END").alias("group_keys"))


def park_status(spark: SparkSession, base: str) -> DataFrame:
    """Status changes of the sites that visits stand at; some NULL."""
    return _events(spark, base).select(
        F.col("event_id"), F.expr("concat('org', user_id % 7)").alias("org"), F.expr("concat('r', user_id % 5)").alias("region"),
        F.col("event_type").alias("site"),
        F.expr("CASE k % 5 WHEN 0 THEN 'Active' WHEN 1 THEN 'Created' WHEN 2 THEN 'Stopped' WHEN 3 THEN 'Inactive' END").alias("status"),
        F.col("ts").alias("created"))


def notice_facts(spark: SparkSession, base: str) -> DataFrame:
    """Facts of notices at the visits' sites: two per breach, some without a breach."""
    return _events(spark, base).select(
        F.col("event_id"), F.expr("event_id div 4").alias("case_id"),
        F.expr("CASE WHEN event_id % 41 <> 0 THEN event_id div 2 END").alias("breach_id"),
        F.expr("concat('org', user_id % 7)").alias("org"), F.expr("concat('r', user_id % 5)").alias("region"),
        F.col("event_type").alias("site"), F.expr("timestampadd(SECOND, k, ts)").alias("fact_ts"), F.col("ts").alias("offense_time"),
        F.expr("CASE WHEN k % 5 = 0 THEN 'Open' ELSE 'Closed' END").alias("state"),
        F.expr("CASE k % 9 WHEN 0 THEN 'nip' WHEN 1 THEN 'defaulted' WHEN 2 THEN 'Paid-Online' WHEN 3 THEN 'Appeal-pending' "
               "WHEN 4 THEN 'lprError' WHEN 5 THEN 'bankpayment' WHEN 6 THEN 'breachError' WHEN 7 THEN 'issued' END").alias("substate"),
        F.expr("CAST(20 + k AS DOUBLE)").alias("value"),
        F.expr("CASE WHEN k % 4 <> 0 THEN CAST(k AS DOUBLE) / 2 END").alias("receipts"))


def org_timezone(spark: SparkSession) -> DataFrame:
    """Organisation → IANA zone lookup (7 rows; org6 deliberately missing)."""
    return literal_table(spark, ORG_TIMEZONES, ["org", "timezone"])


def site_log(spark: SparkSession, base: str) -> DataFrame:
    """Append-only site/group action log; current state = newest row per key."""
    e = _events(spark, base)
    return e.select(
        F.col("event_id"),
        F.expr("concat('site', user_id % 40)").alias("key"),
        F.col("ts").alias("timestamp"),
        F.expr("CASE WHEN k % 10 = 0 THEN 'zone' ELSE 'site' END").alias("type"),
        F.expr("CASE event_type WHEN 'error' THEN 'GroupDeleted' WHEN 'signup' THEN 'GroupCreated' "
               "ELSE 'GroupUpdated' END").alias("action_type"),
        F.expr("concat('r', user_id % 5)").alias("parent"),
        F.expr("concat('org', user_id % 7)").alias("organization"),
        F.expr("concat('Site ', user_id % 40, ' v', k % 3)").alias("name"),
        F.expr("concat('{\"bays\": \"', CASE WHEN k % 9 = 0 THEN 'x' ELSE CAST(k % 50 AS STRING) END, "
               "'\", \"tags\": [\"t', k % 4, '\", \"t', k % 3 + 4, '\"], \"lat\": 51.', "
               "lpad(CAST(user_id % 40 AS STRING), 2, '0'), ', \"lon\": -0.', "
               "lpad(CAST(k AS STRING), 3, '0'), '}')").alias("json"),
    )


def site_status(spark: SparkSession, base: str) -> DataFrame:
    """Site status changes; NULL status for one event type."""
    e = _events(spark, base)
    return e.select(
        F.col("event_id"),
        F.expr("concat('org', user_id % 7)").alias("org"),
        F.expr("concat('r', user_id % 5)").alias("region"),
        F.expr("concat('site', user_id % 40)").alias("site"),
        F.expr("CASE event_type WHEN 'view' THEN 'Active' WHEN 'click' THEN 'Created' "
               "WHEN 'error' THEN 'Inactive' WHEN 'purchase' THEN 'active' END").alias("status"),
        F.col("ts").alias("created"),
    )


def plate_events(spark: SparkSession, base: str) -> DataFrame:
    """Camera reads: capture/receipt times, entry flag, hex sequence number."""
    e = _events(spark, base)
    return e.select(
        F.col("event_id"),
        F.col("ts"),
        F.expr("CASE WHEN event_id % 17 = 0 THEN NULL "
               "ELSE timestampadd(SECOND, CAST(round(value) AS BIGINT), ts) END").alias("received_ts"),
        F.expr("event_id % 2 = 0").alias("entry"),
        F.expr("concat('org', user_id % 7, '#r', k % 5, '#', event_type)").alias("ors_id"),
        F.expr("concat('cam', user_id % 12)").alias("device_id"),
        F.expr("CASE WHEN event_id % 19 = 0 THEN 'zz' ELSE hex(event_id) END").alias("seq_hex"),
    )


def process_metrics(spark: SparkSession, base: str) -> DataFrame:
    """Per-batch processing counts; total 0 exercises the safe ratio."""
    e = _events(spark, base)
    return e.select(
        F.col("event_id"),
        F.expr("concat('org', user_id % 7)").alias("org"),
        F.expr("concat('r', user_id % 5)").alias("region"),
        F.col("event_type").alias("site"),
        F.col("ts").alias("start_time"),
        F.expr("least(k % 4, event_id % 4)").alias("accepted"),
        F.expr("k % 4 - least(k % 4, event_id % 4)").alias("rejected"),
        F.expr("k % 4").alias("total"),
    )


def case_events(spark: SparkSession, base: str) -> DataFrame:
    """User events on cases: status changes carry a JSON value."""
    e = _events(spark, base)
    st = "CASE k % 4 WHEN 0 THEN 'Open' WHEN 1 THEN 'Pending' WHEN 2 THEN 'Resolved' ELSE 'Closed' END"
    return e.select(
        F.col("event_id"),
        F.expr("concat('case/', user_id)").alias("case_uri"),
        F.col("ts"),
        F.expr("CASE event_type WHEN 'signup' THEN 'CaseCreated' WHEN 'view' THEN 'StatusChanged' "
               "WHEN 'purchase' THEN 'StatusChanged' WHEN 'click' THEN 'NoteAdded' "
               "ELSE 'CorrespondenceAdded' END").alias("type"),
        F.expr(f"CASE WHEN event_type IN ('view', 'purchase') THEN concat('{{\"value\": \"', {st}, '\"}}') "
               f"WHEN event_type = 'error' THEN concat('{{\"tags\": {{\"correspondence\": \"', {st}, '\"}}}}') "
               f"ELSE '{{}}' END").alias("data"),
        F.expr("CASE WHEN k % 7 = 0 THEN NULL ELSE concat('agent', k % 6) END").alias("author"),
    )


def correspondence(spark: SparkSession, base: str) -> DataFrame:
    """Correspondence actions with a JSON label and the mail's label flags (some without flags)."""
    e = _events(spark, base)
    return e.select(
        F.col("event_id"),
        F.expr("concat('corr/', user_id % 60)").alias("uri"),
        F.col("ts"),
        F.expr("concat('{\"label\": \"', CASE WHEN k % 5 = 0 THEN 'Linked' WHEN k % 2 = 0 THEN 'Resolved' "
               "ELSE 'Unresolved' END, '\"', CASE WHEN k % 7 = 0 THEN '' WHEN k % 5 = 0 THEN ', \"mailUpdate\": {\"labels\": {\"Linked\": \"true\"}}' "
               "WHEN k % 2 = 0 THEN ', \"mailUpdate\": {\"labels\": {\"Resolved\": \"true\", \"Unresolved\": \"false\"}}' "
               "WHEN k % 3 = 0 THEN ', \"mailUpdate\": {\"labels\": {\"Unresolved\": \"true\"}}' "
               "ELSE ', \"mailUpdate\": {\"labels\": {\"Resolved\": \"false\", \"Unresolved\": \"true\"}}' END, '}')").alias("data"),
        F.expr("concat('{\"name\": \"user', k % 8, '\"}')").alias("user_json"),
    )


def permits(spark: SparkSession, base: str) -> DataFrame:
    """Permits from orders: validity tier by priority (open-ended, far future)."""
    o = scan(spark, base, "orders")
    return o.select(
        F.col("o_orderkey").alias("permit_id"),
        F.expr("concat('org', o_custkey % 7)").alias("org"),
        F.expr("concat('r', o_custkey % 5)").alias("region"),
        F.expr("concat('S', o_custkey % 20)").alias("site"),
        F.expr("concat('P', o_custkey)").alias("plate"),
        F.col("o_orderdate").alias("start_time"),
        F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN timestampadd(DAY, 7, o_orderdate) "
               "WHEN '2-HIGH' THEN timestampadd(DAY, 30, o_orderdate) "
               "WHEN '3-MEDIUM' THEN timestampadd(DAY, 90, o_orderdate) "
               "WHEN '4-NOT SPECIFIED' THEN NULL "
               "ELSE TIMESTAMP_NTZ '2099-06-30 00:00:00' END").alias("end_time"),
        F.expr("timestampadd(SECOND, -(o_orderkey % 600), o_orderdate)").alias("request_time"),
        F.expr("timestampadd(SECOND, o_orderkey % 7200, o_orderdate)").alias("response_time"),
        F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN 12.5D WHEN '2-HIGH' THEN 40.0D "
               "WHEN '3-MEDIUM' THEN 100.0D WHEN '4-NOT SPECIFIED' THEN 0.0D ELSE 5.0D END").alias("amount"),
        F.expr("CASE WHEN o_orderstatus = 'P' THEN 'exemption' ELSE 'permit' END").alias("kind"),
        F.expr("CASE o_orderkey % 5 WHEN 0 THEN concat('org', o_custkey % 7, '#r', o_custkey % 5, '#S', o_custkey % 20, '#cam') "
               "WHEN 1 THEN 'console' WHEN 2 THEN 'app' WHEN 3 THEN 'import' END").alias("permit_source"),
    )


def exemptions(spark: SparkSession, base: str) -> DataFrame:
    """Exempted vehicles from events: site and plate keys of the visits, open and 2099 ends."""
    return _events(spark, base).where("event_id % 29 = 0").select(
        F.col("event_id").alias("permit_id"),
        F.expr("concat('org', user_id % 7)").alias("org"),
        F.expr("concat('r', k % 5)").alias("region"),
        F.col("event_type").alias("site"),
        F.expr("concat('P', user_id)").alias("plate"),
        F.expr("timestampadd(HOUR, -24, ts)").alias("start_time"),
        F.expr("CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP_NTZ '2099-06-30 00:00:00' "
               "ELSE timestampadd(HOUR, 120, ts) END").alias("end_time"),
        F.expr("CASE WHEN event_id % 2 = 0 THEN timestampadd(SECOND, k - 86500, ts) END").alias("response_time"),
    )


def permit_visits(spark: SparkSession, base: str) -> DataFrame:
    """Vehicle visits to match against permits: one per line item."""
    o = scan(spark, base, "orders").select("o_orderkey", "o_custkey")
    li = scan(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("l_orderkey").alias("visit_order"),
        F.col("l_linenumber").alias("visit_line"),
        F.expr("concat('P', o_custkey)").alias("plate"),
        F.expr("concat('S', o_custkey % 20)").alias("site"),
        F.expr("timestampadd(HOUR, l_linenumber, l_shipdate)").alias("arrival"),
        F.expr("timestampadd(HOUR, l_linenumber + CAST(l_quantity AS BIGINT), l_shipdate)").alias("departure"),
    )


def payments(spark: SparkSession, base: str) -> DataFrame:
    """Payments stored as 7-day segments (one per line number) of a transaction."""
    li = scan(spark, base, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").alias("segment"),
        F.expr("concat('org', l_suppkey % 7)").alias("org"),
        F.expr("concat('r', l_suppkey % 5)").alias("region"),
        F.expr("concat('S', l_suppkey % 20)").alias("site"),
        F.expr("concat('P', l_partkey % 300)").alias("plate"),
        F.expr("timestampadd(DAY, (l_linenumber - 1) * 7, l_shipdate)").alias("start_time"),
        F.expr("timestampadd(DAY, l_linenumber * 7, l_shipdate)").alias("end_time"),
        F.expr("CAST(l_quantity AS BIGINT) * 60").alias("duration_seconds"),
        (F.col("l_extendedprice") / 100).alias("amount"),
        (F.col("l_extendedprice") / 10).alias("total_amount"),
        F.expr("timestampadd(MINUTE, -l_linenumber, l_shipdate)").alias("request_time"),
        F.expr("concat('app#', l_returnflag)").alias("source"),
    )


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """Financial ledger lines per notice (breach)."""
    li = scan(spark, base, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("breach_id"),
        F.col("l_linenumber").alias("line_no"),
        F.expr("concat('S', l_suppkey % 20)").alias("site"),
        F.expr("timestampadd(HOUR, l_linenumber, l_shipdate)").alias("time"),
        F.expr("CASE l_returnflag WHEN 'R' THEN 'Payment' WHEN 'A' THEN 'Refund' ELSE 'Fee' END")
        .alias("transaction_type"),
        F.expr("CASE l_linestatus WHEN 'F' THEN 'Base fee' ELSE 'Late fee' END").alias("description"),
        (F.col("l_extendedprice") / 50).alias("debit"),
        (F.col("l_extendedprice") * F.col("l_discount") / 5).alias("credit"),
    )


def cases(spark: SparkSession, base: str, with_breaches: bool = True) -> DataFrame:
    """Revisioned notices with nested breaches → fees / transactions.

    One row per order (three revisions per case id), breaches = its line
    items.  Built with one shuffle (line items grouped by order key: a
    bounded group, a handful of lines per order), joined to orders on the
    same key, both dealt over tasks by the number of lines.  Orders without lines get a NULL breach array.  Reports that
    read no breach pass ``with_breaches=False`` and skip the nesting job
    (Catalyst cannot drop a left join it does not know to be 1:1).
    """
    o = scan(spark, base, "orders")
    if not with_breaches:
        return _case_columns(o.withColumn("breaches", F.lit(None).cast(
            "array<struct<ticket_id:bigint,issuing_time:timestamp_ntz,"
            "fees:array<struct<amount:double,source:string,type:string>>,"
            "transactions:array<struct<amount:double,description:string>>,line_status:string>>"))).drop("breaches")
    li = scan(spark, base, "lineitem")
    # group flat line columns (cheap to buffer and shuffle), nest afterwards per row
    flat = F.struct("l_linenumber", "l_shipdate", "l_extendedprice", "l_tax", "l_discount", "l_returnflag",
                    "l_linestatus")
    size = li.count()  # from the files' footers
    lines = spread(li, size, "l_orderkey").groupBy("l_orderkey").agg(F.collect_list(flat).alias("__lines"))

    def breach(x):
        return F.struct(
            (F.expr("l_orderkey div 3") * 100 + x["l_linenumber"]).alias("ticket_id"),
            x["l_shipdate"].alias("issuing_time"),
            F.array(
                F.struct((x["l_extendedprice"] / 1000).alias("amount"),
                         F.lit("base").alias("source"), F.lit("parking").alias("type")),
                F.struct((x["l_tax"] * 100).alias("amount"), F.lit("late").alias("source"), F.lit("late").alias("type")),
            ).alias("fees"),
            F.when(x["l_returnflag"] == "N",
                   F.array().cast("array<struct<amount:double,description:string>>"))
            .otherwise(F.array(F.struct((x["l_extendedprice"] * (1 - x["l_discount"]) / 10).alias("amount"),
                                        F.concat(F.lit("pay"), x["l_linenumber"].cast("string")).alias("description"))))
            .alias("transactions"),
            x["l_linestatus"].alias("line_status"),
        )

    lines = lines.select("l_orderkey", F.transform("__lines", breach).alias("breaches"))
    o = spread(o, size, "o_orderkey")
    return _case_columns(o.join(lines, o.o_orderkey == lines.l_orderkey, "left"))


def _case_columns(j: DataFrame) -> DataFrame:
    return j.select(
        F.expr("o_orderkey div 3").alias("id"),
        F.expr("o_orderkey % 3").alias("rev"),
        F.col("o_orderkey").alias("order_key"),
        F.expr("concat('case/', o_orderkey div 3)").alias("uri"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'closed' END").alias("state"),
        F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN 'paid' WHEN '2-HIGH' THEN 'cancelled' "
               "WHEN '3-MEDIUM' THEN 'appealed' WHEN '5-LOW' THEN 'issued' END").alias("substate"),
        F.expr("array(concat('s', o_custkey % 3), concat('s', o_custkey % 4 + 3))").alias("sub_states"),
        F.expr("CASE o_custkey % 3 WHEN 0 THEN 'Europe/Copenhagen' WHEN 1 THEN 'Europe/Berlin' "
               "ELSE 'Europe/London' END").alias("timezone"),
        F.expr("timestampadd(MINUTE, o_orderkey % 1440, o_orderdate)").alias("fact_ts"),
        F.col("o_orderdate").alias("case_ts"),
        F.expr("CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'duplicate' END").alias("canceled_reason"),
        F.expr("concat('org', o_custkey % 7)").alias("organization"),
        F.expr("array(named_struct('type', 'site', 'group_ref', "
               "concat('org', o_custkey % 7, '#r', o_custkey % 5, '#S', o_custkey % 20), "
               "'name', concat('Site ', o_custkey % 20)), "
               "named_struct('type', 'zone', 'group_ref', concat('Z', o_custkey % 3), 'name', 'Zone'))").alias("groups"),
        F.struct(
            F.expr("concat('P', o_custkey)").alias("plate"),
            F.expr("CASE o_custkey % 5 WHEN 0 THEN 'DK' WHEN 1 THEN 'DE' WHEN 2 THEN 'GB' WHEN 3 THEN 'SE' END")
            .alias("state"),
        ).alias("vehicle"),
        F.col("o_orderdate").alias("arrival"),
        F.expr("timestampadd(MINUTE, o_orderkey % 300, o_orderdate)").alias("departure"),
        F.expr("CASE WHEN o_orderkey % 11 <> 0 THEN filter(array("
               "named_struct('offense_time', timestampadd(HOUR, o_orderkey % 2000, o_orderdate)), "
               "CASE WHEN o_orderkey % 4 = 0 THEN named_struct('offense_time', timestampadd(DAY, 35, o_orderdate)) END), "
               "x -> x IS NOT NULL) END").alias("offenses"),
        F.col("breaches"),
    )


def fact_visit(spark: SparkSession, base: str) -> DataFrame:
    """Visit fact of the star schema: one row per line item."""
    li = scan(spark, base, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("visit_key"),
        F.col("l_suppkey").alias("site_key"),
        F.col("l_partkey").alias("vehicle_key"),
        F.expr("timestampadd(MINUTE, l_orderkey % 1440, l_shipdate)").alias("entry_time"),
        F.expr("timestampadd(MINUTE, l_orderkey % 1440 + CAST(l_quantity AS BIGINT) * 7, l_shipdate)")
        .alias("exit_time"),
        F.expr("CAST(l_shipdate AS DATE)").alias("entry_date"),
        F.expr("CAST(timestampadd(MINUTE, l_orderkey % 1440 + CAST(l_quantity AS BIGINT) * 7, l_shipdate) AS DATE)")
        .alias("exit_date"),
        F.col("l_returnflag").alias("vehicle_indicator"),
    )


def dim_site(spark: SparkSession, base: str) -> DataFrame:
    s = scan(spark, base, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = scan(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = scan(spark, base, "region").select("r_regionkey", "r_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
             .select(F.col("s_suppkey").alias("site_key"), F.col("s_name").alias("site_name"),
                     F.col("n_name").alias("country"), F.col("r_name").alias("region_name")))


def dim_vehicle(spark: SparkSession, base: str) -> DataFrame:
    p = scan(spark, base, "part")
    return p.select(F.col("p_partkey").alias("vehicle_key"),
                    F.expr("concat('P', p_partkey)").alias("plate"),
                    F.col("p_brand").alias("make"), F.col("p_type").alias("body"))


def dim_date(spark: SparkSession, base: str) -> DataFrame:
    """One row per calendar day from the first to the last ship date."""
    li = scan(spark, base, "lineitem")
    bounds = li.agg(F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi"))
    d = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return d.select("date", F.year("date").alias("year"), F.month("date").alias("month"),
                    F.date_format("date", "EEEE").alias("day_name"))


def cutover(spark: SparkSession, base: str) -> DataFrame:
    """Per-site date from which the new visit source is used (some sites absent)."""
    s = scan(spark, base, "supplier")
    return (s.where("s_suppkey % 4 <> 0")
             .select(F.col("s_suppkey").alias("site_key"),
                     F.expr("date_add(DATE '1997-01-01', CAST(s_suppkey * 37 % 1500 AS INT))")
                     .alias("transition_date")))


# Fixed values of the test mapping: polygon templates as (dx, dy) offsets in
# a 2 x 2 cell; the first ring is the outline (counter-clockwise), further
# rings are holes (clockwise).
POLYGON_TEMPLATES = {
    0: [[(0, 0), (2, 0), (2, 2), (0, 2)]],
    1: [[(0, 0), (2, 0), (0, 2)]],
    2: [[(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)]],
    3: [[(0, 0), (2, 0), (2, 2), (0, 2)], [(0.5, 0.5), (0.5, 1.5), (1.5, 1.5), (1.5, 0.5)]],
    4: [[(1, 0), (2, 1), (1, 2), (0, 1)]],
}


def polygons(spark: SparkSession, base: str) -> DataFrame:
    """One polygon per nation on a 5 x 5 layout of 2 x 2 cells; the shape cycles by key."""
    n = scan(spark, base, "nation")
    i = (F.col("n_nationkey") % 5).cast("double")
    j = F.expr("n_nationkey div 5").cast("double")
    shape = F.expr("(n_nationkey + n_nationkey div 5) % 5")
    rings = None
    for s, tmpl in POLYGON_TEMPLATES.items():
        arr = F.array(*[F.array(*[F.struct((2 * i + F.lit(float(dx))).alias("lon"), (2 * j + F.lit(float(dy))).alias("lat"))
                                  for dx, dy in ring]) for ring in tmpl])
        rings = F.when(shape == s, arr) if rings is None else rings.when(shape == s, arr)
    return n.select("n_nationkey", "n_name", rings.alias("rings"))


def points(spark: SparkSession, base: str) -> DataFrame:
    """Site locations from customer keys (0.1 grid, so some lie exactly on polygon edges)."""
    c = scan(spark, base, "customer")
    return c.select("c_custkey", "c_mktsegment",
                    ((F.col("c_custkey") % 100).cast("double") / 10).alias("lon"),
                    ((F.col("c_custkey") * 7 % 100).cast("double") / 10).alias("lat"))
