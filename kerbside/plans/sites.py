"""Site reports: registry, status, match rates, delays, camera gaps, breach grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.timefn import between_local_days, local_date, parse_day
from kerbside.functions.values import hex_to_long, json_text, recode, safe_ratio
from kerbside.operators import windows as W


def current_sites(log: DataFrame, key: str = "key", ts: str = "timestamp", drop_deleted: bool = True) -> DataFrame:
    """Log rows at each key's newest 'site' timestamp (ties kept), deleted sites removed."""
    cur = W.latest_ties(log, key, ts, inner=F.col("type") == "site")
    return cur.where(F.col("action_type") != "GroupDeleted") if drop_deleted else cur


def site_registry(log: DataFrame, tags_path: str = "$.tags") -> DataFrame:
    """Current sites, one row per tag (sites without tags disappear), bay count, location."""
    cur = current_sites(log)
    tags = F.split(F.regexp_replace(json_text("json", tags_path), r'[\[\]"]', ""), ",")
    out = cur.select("key", "organization", "parent", "name", F.explode(tags).alias("tag"),
                     json_text("json", "$.bays").try_cast("int").alias("bays"),
                     F.concat_ws(",", json_text("json", "$.lat"), json_text("json", "$.lon")).alias("location"))
    return out.withColumn("tag", F.trim("tag"))


STATUS_MAP = {"Pending": ["Created"]}


def site_status(status: DataFrame, keys, ts: str, tiebreak: str | None = None) -> DataFrame:
    """Newest status per site; NULL → 'Active', 'Created' → 'Pending'."""
    latest = W.latest_by_key(status, keys, ts, tiebreak=tiebreak)
    s = F.coalesce(F.col("status"), F.lit("Active"))
    return latest.withColumn("status", recode(s, STATUS_MAP, lower=False))


def process_rates(metrics: DataFrame, tz: str, start, end, keys=("org", "region", "site")) -> DataFrame:
    """Accepted / total and footfall per site and local day."""
    from kerbside.functions.timefn import between_local_days
    d = local_date("start_time", tz)
    m = metrics.where(between_local_days("start_time", tz, start, end))
    return m.groupBy(*keys, d.alias("day")).agg(
        F.sum("accepted").alias("accepted"), F.sum("total").alias("total"),
        safe_ratio(F.sum("accepted"), F.sum("total")).alias("process_rate"))


def raw_flows(reads: DataFrame, keys, tz: str, start, end) -> DataFrame:
    """Entry and exit reads per key and local day (with a pushed-down UTC pre-filter)."""
    from kerbside.functions.timefn import between_local_days
    keys = [keys] if isinstance(keys, str) else list(keys)
    r = reads.where(between_local_days("ts", tz, start, end))
    return r.groupBy(*keys, local_date("ts", tz).alias("day")).agg(F.sum(F.col("entry").cast("int")).alias("entries"),
                                               F.sum(F.when(~F.col("entry"), 1).otherwise(0)).alias("exits"))


def raw_match_rate(entries: Column, exits: Column) -> Column:
    """min(in, out) relative to the mean of in and out."""
    mean = (entries + exits) / 2
    return F.least(exits / mean, entries / mean)


def delivery_delays(reads: DataFrame, key: str, ts: str, received: str) -> DataFrame:
    """Count, min, mean, max of capture→receipt minutes (minute boundaries crossed)."""
    mins = ((F.unix_seconds(F.date_trunc("minute", F.col(received)).cast("timestamp"))
             - F.unix_seconds(F.date_trunc("minute", F.col(ts)).cast("timestamp"))) / 60).cast("bigint")
    r = reads.where(F.col(received).isNotNull()).withColumn("__m", mins)
    return r.groupBy(key).agg(F.count(F.lit(1)).alias("events"), F.min("__m").alias("min_delay"),
                              F.avg("__m").alias("avg_delay"), F.max("__m").alias("max_delay"))


def camera_gaps(reads: DataFrame, device: str, seq_hex: str) -> DataFrame:
    """Images and missing images per camera from hex sequence numbers.

    The gap is taken over one global order (device desc, sequence desc), as
    the reference does -- computed without a single-partition sort (see
    :func:`kerbside.operators.windows.sequence_gaps`).  A step of -1 is
    normal; a step of -n means n-1 images are missing.
    """
    r = reads.select(device, hex_to_long(seq_hex).alias("seq"))
    g = W.sequence_gaps(r, device, "seq", descending=True)
    return g.groupBy(device).agg(
        F.count(F.lit(1)).alias("images"),
        F.sum(F.when(F.col("gap") < -1, -F.col("gap") - 1).otherwise(0)).alias("missing_images"))


WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def weekday_compare(breaches: DataFrame, site: str, ts: str, breach_id: str, start, end, tz: str,
                    this_week: tuple[int, int] = (-13, -7), last_week: tuple[int, int] = (-21, -13),
                    reach: int = 13) -> DataFrame:
    """Distinct breaches per site x {weekday, 'Last ' + weekday}, zero-filled.

    Weeks are local days at offsets from ``end`` (a day in both is of this
    week); days more than ``reach`` before ``start`` are not read.  The last
    week's offsets span more than seven days, so a breach id that falls on
    the same weekday twice counts once.  Only sites with a breach in either
    week are in the grid, which is generated per site (14 labels).
    """
    s, e = parse_day(start), parse_day(end)

    def within(w: tuple[int, int]) -> Column:
        lo, hi = (F.lit(e + dt.timedelta(days=x)) for x in w)
        return F.col("day").between(lo, hi)

    weekday = F.date_format("day", "EEEE")
    label = F.when(within(this_week), weekday).when(within(last_week), F.concat(F.lit("Last "), weekday))
    b = breaches.where(between_local_days(ts, tz, s - dt.timedelta(days=reach), e)) \
        .select(site, local_date(ts, tz).alias("day"), breach_id).withColumn("label", label).where("label IS NOT NULL")
    counts = b.groupBy(site, "label").agg(F.count_distinct(breach_id).alias("breaches"))
    labels = F.array(*[F.lit(p + d) for d in WEEKDAYS for p in ("", "Last ")])
    grid = counts.select(F.col(site).alias(site)).distinct().select(site, F.explode(labels).alias("label"))
    return grid.join(counts, [site, "label"], "left").select(site, "label", F.coalesce("breaches", F.lit(0)).alias("breaches"))


def sites_without(breaches: DataFrame, sites: DataFrame, site: str, day: str, start, end) -> DataFrame:
    """(site, day) of every site in ``sites`` and day in [start, end] without a breach.

    By gaps: each site's existing days, led by the day before ``start``, are compared with the next one (or
    the day after ``end``), and only the days between are generated.  A site that never had a breach has the
    whole range; no grid and no anti join.
    """
    s, e = parse_day(start), parse_day(end)
    known = sites.select(site).distinct()
    hit = breaches.where(F.col(day).between(F.lit(s), F.lit(e))).select(site, F.col(day).alias("d")).distinct().join(known, site, "left_semi")
    marks = hit.unionByName(known.select(site, F.lit(s - dt.timedelta(days=1)).alias("d")))
    gaps = W.with_next(marks, site, "d", ["d"], limit=None)
    until = F.coalesce("next_d", F.lit(e + dt.timedelta(days=1)))
    return gaps.where(F.date_add("d", 1) < until) \
        .select(site, F.explode(F.sequence(F.date_add("d", 1), F.date_sub(until, 1))).alias(day))


def rate_anomalies(metrics: DataFrame, tz: str, start=None, end=None, org: str | None = None, back: int = 30,
                   lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Daily match rate per site with the ``back`` rates before it, the site's band and whether the rate is outside.

    ``start``, ``end`` (local days) and ``org`` bound what is read; the band and the rates before are of the
    days read.  The band is the exact interpolated percentile of the site's days.
    """
    m = metrics
    if org is not None:
        m = m.where(F.col("org") == org)
    if start is not None:
        m = m.where(between_local_days("start_time", tz, start, end))
    d = m.groupBy("org", "region", "site", local_date("start_time", tz).alias("d")).agg(
        F.try_divide(F.sum("accepted"), F.sum("total")).alias("rate"), F.sum("total").alias("footfall"))
    h = W.rolling_values(d.withColumn("__r", F.coalesce("rate", F.lit(0.0))), "site", ["d", "org", "region"], "__r", back, name="prev")
    b = W.percentile_band(h, "site", "rate", lo, hi, names=("lower_band", "upper_band"))
    return b.drop("__r").withColumn("is_anomaly", (F.col("rate") < F.col("lower_band")) | (F.col("rate") > F.col("upper_band")))


def current_devices(log: DataFrame, kind: str = "mav-camera") -> DataFrame:
    """Devices at their newest row of the kind (ties kept), deleted ones gone, one row per site group:
    device_id, camera_name, group_ref."""
    cur = W.latest_ties(log, "device_id", "timestamp", inner=F.col("device_type") == kind).where(F.col("action_type") != "DeviceDeleted")
    return cur.select("device_id", F.col("name").alias("camera_name"), F.explode("group_keys").alias("group_ref"))


def image_gaps(reads: DataFrame, devices: DataFrame, sites: DataFrame, start, end, tz: str) -> DataFrame:
    """Every image of the period's local days with its difference to the image before it in the one order of all
    devices (device ascending, number descending), with camera and site names; images of unregistered cameras or
    sites are out after the differences are taken.  A normal step is -1."""
    from kerbside.plans.dimension import key_parts, with_site
    r = reads.where(between_local_days("ts", tz, start, end)).select("event_id", "device_id", hex_to_long("seq_hex").alias("seq"), local_date("ts", tz).alias("day"))
    g = W.sequence_gaps(r, "device_id", "seq", descending=True, name="difference")
    g = g.join(devices, "device_id")
    return with_site(g, sites, key_parts("group_ref"), how="inner").select("event_id", "device_id", "camera_name", "site_name", "seq", "day", "difference")


def breach_states(facts: DataFrame, sites: DataFrame, zones: DataFrame, start, end, excluded=("breachError", "nip")) -> DataFrame:
    """Breaches per (site, local offence day, state) of every current site, with code, status and the breach ids.

    The newest fact of each ticket *among those whose local offence day is in [start, end]* counts; a closed one
    with an ``excluded`` sub-state goes, and so does a closed one without a sub-state (the test is NULL there).
    ``sites`` has site_ref, site_name, site_code, site_status; a site without a breach gives one row with 0.
    Only facts of the sites are counted.  A day's ids of a site and state are one text.
    """
    from kerbside.operators.aggregates import collect_sorted_text
    s, e = parse_day(start), parse_day(end)
    bound = lambda d, n: F.lit(dt.datetime.combine(d + dt.timedelta(days=n), dt.time())).cast("timestamp_ntz")
    near = facts.where((F.col("offense_time") >= bound(s, -1)) & (F.col("offense_time") < bound(e, 2)))
    f = near.join(zones, "org", "left").where(between_local_days("offense_time", F.col("timezone"), start, end))
    f = f.withColumn("day", local_date("offense_time", F.col("timezone"))).withColumn("site_ref", F.concat_ws("#", "org", "region", "site"))
    new = W.latest_by_key(f, "breach_id", "fact_ts", tiebreak="event_id")
    closed = F.col("state") == "Closed"
    for x in excluded:
        new = new.where(~(closed & (F.col("substate") == x)))
    counts = new.groupBy("site_ref", "day", "state").agg(
        F.count_distinct("breach_id").alias("breaches"), collect_sorted_text(F.col("breach_id").cast("string"), distinct=True).alias("breach_ids"))
    return counts.join(sites, "site_ref", "right").select(
        "site_ref", "site_name", "site_code", "site_status", "state", "day", F.coalesce("breaches", F.lit(0)).alias("breaches"), "breach_ids")
