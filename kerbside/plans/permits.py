"""Permit and payment reports: consolidated table, compliance feed, permit usage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.timefn import local_time, parse_day
from kerbside.operators import aggregates as A
from kerbside.operators import sweep as S
from kerbside.operators import windows as W
from kerbside.operators.ranges import spread, stored

OPEN_END = dt.datetime(2099, 1, 1)


def permits_and_payments(permits: DataFrame, payments: DataFrame) -> DataFrame:
    """Exemptions + permits + de-duplicated payments in one table (aligned by name).

    * exemptions: open ends become 2099-01-01;
    * payments: one row per (plate, start, end) -- the earliest request --
      with the duration in minutes;
    * ``group_key`` = region || site (the reference's added column).
    """
    # exemptions and permits come from one scan of the permit table
    is_ex = F.col("kind") == "exemption"
    pm = (permits.where(F.col("kind").isin("exemption", "permit"))
          .select("start_time",
                  F.when(is_ex, F.coalesce("end_time", F.lit(OPEN_END).cast("timestamp_ntz")))
                  .otherwise(F.col("end_time")).alias("end_time"),
                  "region", "site", "plate", "amount", "request_time",
                  F.col("permit_id").cast("string").alias("permit_id"), F.col("kind").alias("record_type")))
    pay = W.earliest_by_key(payments, ["plate", "start_time", "end_time"], "request_time",
                            tiebreak=["transaction_id", "segment"])
    pay = pay.select("start_time", "end_time", "region", "site", "plate", "amount", "request_time",
                     F.col("transaction_id").alias("transaction_id"), "source",
                     (F.col("duration_seconds") / 60).alias("duration"), F.lit("payment").alias("record_type"))
    out = pm.unionByName(pay, allowMissingColumns=True)
    return out.withColumn("group_key", F.concat("region", "site"))


def consolidated_payments(payments: DataFrame, since) -> DataFrame:
    """Payments of the segments that start from ``since`` (UTC day) on: one per transaction with the sums of amount
    and minutes from first start to last end, then the newest request per (plate, start, end)."""
    whole = payments.where(F.to_date("start_time") >= F.lit(parse_day(since))) \
        .groupBy("org", "region", "site", "plate", "request_time", "transaction_id", "source") \
        .agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.sum("amount").alias("amount"),
             F.sum(F.col("duration_seconds") / 60).alias("duration"))
    return W.latest_by_key(whole, ["plate", "start_time", "end_time"], "request_time", tiebreak=["transaction_id", "region", "site", "source"])


def permits_and_consolidated_payments(permits: DataFrame, payments: DataFrame, since) -> DataFrame:
    """Exemptions, permits and consolidated payments in one table (see :func:`permits_and_payments`)."""
    pay = consolidated_payments(payments, since).select(
        "start_time", "end_time", "region", "site", "plate", "amount", "request_time", "transaction_id", "source", "duration",
        F.lit("payment").alias("record_type"), F.concat("region", "site").alias("group_key"))
    both = permits_and_payments(permits, payments.where("false"))
    return both.unionByName(pay, allowMissingColumns=True)


def compliance(permits: DataFrame, payments: DataFrame, org: str, region: str, site: str, start, end,
               tz, amount_mode: str = "max", reach_months: int = 12) -> DataFrame:
    """Permits and consolidated payments of one site that start in a period and are valid in it locally.

    * permits: start (UTC day) within a day of the period, source not a
      camera of the site (a NULL source is dropped, as ``NOT`` gives), one
      per (plate, permit id);
    * payments are stored as 7-day segments: those that start up to
      ``reach_months`` calendar months off the period (pushed to the scan)
      are consolidated per transaction, plate, request and source, and the
      consolidated start (UTC day) must lie in the period;
    * newest request per (plate, start, end, source), then among those valid
      in the period the longest per (plate, start, source);
    * local validity must overlap [start, end] for both kinds.
    """
    s, e = parse_day(start), parse_day(end)
    site_f = (F.col("org") == org) & (F.col("region") == region) & (F.col("site") == site)
    utc_day = F.to_date("start_time")
    ls, le = local_time("start_time", tz), local_time("end_time", tz)
    valid = (F.to_date(le) >= F.lit(s)) & (F.to_date(ls) <= F.lit(e))
    p = permits.where(site_f & utc_day.between(F.lit(s - dt.timedelta(days=1)), F.lit(e + dt.timedelta(days=1)))
                      & ~F.col("permit_source").startswith(f"{org}#{region}#{site}#"))
    p = W.earliest_by_key(p, ["plate", "permit_id"], "request_time", tiebreak=["start_time", "end_time", "amount"])
    p = p.where(valid).select(F.col("kind").alias("record_type"), "plate", "start_time", "end_time", "request_time", "amount",
                              F.lit(None).cast("double").alias("total_amount"), F.lit(None).cast("bigint").alias("transaction_id"),
                              F.col("permit_id").cast("string").alias("permit_id"), F.col("permit_source").alias("source"),
                              F.lit(None).cast("double").alias("duration"))
    wide = utc_day.between(F.add_months(F.lit(s), -reach_months), F.add_months(F.lit(e), reach_months))
    c = A.consolidate(payments.where(site_f & wide), ["transaction_id", "plate", "request_time", "source"], "start_time",
                      "end_time", "duration_seconds", "amount", amount_mode, extra={"total_amount": F.max("total_amount")})
    c = c.where(utc_day.between(F.lit(s), F.lit(e))).withColumn("source", F.split_part("source", F.lit("#"), F.lit(1)))
    c = W.latest_by_key(c, ["plate", "start_time", "end_time", "source"], "request_time", tiebreak="transaction_id")
    c = W.latest_by_key(c.where(valid), ["plate", "start_time", "source"], "end_time", tiebreak="transaction_id")
    pay = c.select(F.lit("payment").alias("record_type"), "plate", "start_time", "end_time", "request_time", "amount",
                   "total_amount", "transaction_id", F.lit(None).cast("string").alias("permit_id"), "source",
                   (F.col("duration_seconds") / 60).alias("duration"))
    return p.unionByName(pay).select(
        "record_type", "plate", ls.alias("start_local"), le.alias("end_local"),
        local_time("request_time", tz).alias("request_local"), "amount", "total_amount", "transaction_id", "permit_id",
        "source", "duration")


def permit_usage(permits: DataFrame, visits: DataFrame, tiers: Mapping[float, int], tz: str, start, end) -> DataFrame:
    """Permit purchases by price tier, entries within each permit's validity, per month.

    * purchases: permits whose amount is a tier, validity end = local start
      + tier days, one per (plate, start) (lowest amount), counted per
      (site, plate, amount, month, start, end);
    * entries: visits of the same plate at the same site whose arrival OR
      departure lies inside the validity (running counts without pairs for
      plates hot on both sides);
    * purchase_count: purchases of the plate in the month, all sites (the
      rejoin on plate and month, as the report does).
    """
    s, e = parse_day(start), parse_day(end)
    amt = F.col("amount")
    days = None
    for a, d in tiers.items():
        days = F.when(amt == a, F.lit(d)) if days is None else days.when(amt == a, F.lit(d))
    ls = local_time("start_time", tz)
    p = (permits.where(amt.isin(list(tiers)) & F.to_date("start_time").between(F.lit(s), F.lit(e)))
         .select("site", "plate", "amount", ls.alias("permit_start"), days.alias("__days")))
    p = p.withColumn("permit_end", F.expr("timestampadd(DAY, __days, permit_start)")).drop("__days")
    p = spread(p, p.count(), "plate", "permit_start")
    p = W.earliest_by_key(p, ["plate", "permit_start"], "amount", tiebreak="site")
    purchases = (p.groupBy("site", "plate", "amount", F.date_format("permit_start", "yyyy-MM").alias("permit_month"),
                           "permit_start", "permit_end")
                  .agg(F.count(F.lit(1)).alias("purchase_count")))
    purchases = stored(purchases, "purchases")  # read four times below
    # a visit reported several times counts once
    # only visits from a plate's first to its last valid time are converted and told apart; they are
    # in UTC here, so a day is left to each side for the zone
    bought = purchases.groupBy(F.col("site").alias("__s"), F.col("plate").alias("__p")) \
        .agg(F.expr("min(permit_start) - INTERVAL 1 DAY").alias("__lo"), F.expr("max(permit_end) + INTERVAL 1 DAY").alias("__hi"))
    near = visits.join(bought, (visits["site"] == bought["__s"]) & (visits["plate"] == bought["__p"])) \
        .where("arrival BETWEEN __lo AND __hi OR departure BETWEEN __lo AND __hi")
    v = near.select("site", "plate", local_time("arrival", tz).alias("arr"), local_time("departure", tz).alias("dep")).distinct()
    used = S.count_either(purchases, v, ["site", "plate"], "arr", "dep", "permit_start", "permit_end", "entries")
    joined = used.groupBy("plate", "site", "permit_month", "amount").agg(F.sum("entries").alias("entry_count"))
    # the report re-joins every purchase of the plate and month to each row and counts the
    # fan-out; that count is the number of purchase rows per (plate, month), so aggregate
    # first and join one row per (plate, month) -- same numbers, no pairs
    pc = purchases.groupBy("plate", "permit_month").agg(F.count(F.lit(1)).alias("purchase_count"))
    r = joined.join(pc, ["plate", "permit_month"], "left")
    return r.select("plate", "permit_month", "site", "amount", "entry_count",
                    F.coalesce("purchase_count", F.lit(0)).alias("purchase_count"))
