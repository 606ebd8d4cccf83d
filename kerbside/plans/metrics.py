"""Site metrics as one tagged union: every source emits (site, day, measure, value), one aggregate pivots them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.timefn import between_local_days, local_date
from kerbside.operators import windows as W
from kerbside.plans.dimension import PARTS
from kerbside.plans.sites import site_status

KEYS = ("org", "region", "site")

# Sub-states of the notice measures.
NO_REVENUE = ("nip", "svc-cancel", "breachError")
PAID = ("breach-paid-direct", "bankpayment", "paid-online", "paid_online", "paidonline")
CANCELLED = ("nip", "svc-cancel", "breachError", "lprError", "noownershipdetails", "updatedownershipdetails")
DEFAULTED = "defaulted"


def tagged(df: DataFrame, day: Column, measures: Mapping[str, Column]) -> DataFrame:
    """(keys, day, measure, value): one row per input row and measure that is not NULL."""
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), c.cast("double").alias("value")) for n, c in measures.items()])
    return df.select(*KEYS, day.alias("day"), F.explode(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("m")) \
        .select(*KEYS, "day", "m.measure", "m.value")


def pivot_sums(parts: list[DataFrame], measures: list[str]) -> DataFrame:
    """Sums of each measure per (keys, day), NULL where it has no value.  Sums combine map-side, so a hot
    site is one row per task in the only shuffle."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*KEYS, "day").agg(*[F.sum(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in measures])


def notice_measures() -> dict[str, Column]:
    """Measures of a notice row (newest fact of its breach)."""
    sub, closed = F.lower("substate"), F.col("state") == "Closed"
    defaulted = F.coalesce((sub == DEFAULTED) & closed, F.lit(False))
    # the list is compared in lower case as written: its mixed-case entry never matches
    dead = F.coalesce(sub.isin(list(NO_REVENUE)), F.lit(False))
    one = lambda c: F.when(c, 1)
    return {"pcn_count": F.lit(1), "potential_revenue": F.when(dead, 0).otherwise(F.col("value")),
            "realised_revenue": F.when(defaulted, 0).otherwise(F.col("receipts")),
            "paid_count": one(sub.isin(list(PAID)) & closed), "cancelled_count": one(F.col("substate").isin(list(CANCELLED))),
            "appeals_count": one(sub.contains("appeal") & closed), "debt_count": one(defaulted),
            "debt_receipts": F.when(defaulted, F.col("receipts"))}


def site_metrics(sites: DataFrame, status: DataFrame, processed: DataFrame, reads: DataFrame, visits: DataFrame,
                 notices: DataFrame, start, end, tz: str) -> DataFrame:
    """Per registered site and processing day: match rate, footfall, raw footfall, visits, mean stay, eight
    notice measures, name, status and status day.

    Rows stand on the days with processed plates; a site without any has one row without a day.  Each
    source is bounded to the period before it is read further; of a breach the newest fact counts (ranked over
    all facts, then bounded by the offence day, as the report does).
    """
    day = lambda c: local_date(c, tz)
    within = lambda c: between_local_days(c, tz, start, end)
    newest = W.latest_by_key(notices.where(F.col("breach_id").isNotNull()), ["case_id", "breach_id"], "fact_ts", tiebreak="event_id")
    newest = newest.where(within("offense_time"))
    parts = [tagged(processed.where(within("start_time")), day("start_time"),
                    {"accepted": F.col("accepted"), "total": F.col("total"), "batches": F.lit(1)}),
             tagged(reads.where(within("ts")), day("ts"), {"reads": F.when(F.col("entry").isNotNull(), 1)}),
             tagged(visits.where(within("arrival")), day("arrival"),
                    {"visits": F.lit(1), "stay": F.col("stay_minutes")}),
             tagged(newest, day("offense_time"), notice_measures())]
    names = ["accepted", "total", "batches", "reads", "visits", "stay", *notice_measures()]
    m = pivot_sums(parts, names).where(F.col("batches") > 0)
    state = site_status(status, list(KEYS), "created", tiebreak="event_id") \
        .select(*KEYS, F.col("status").alias("site_status"), local_date("created", tz).alias("status_day"))
    dim = sites.select(*[F.col(c).alias(k) for c, k in zip(PARTS, KEYS)], "name")
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return dim.join(state, list(KEYS), "left").join(m, list(KEYS), "left").select(
        *KEYS, "name", "day", F.try_divide("accepted", "total").alias("match_rate"), F.col("total").cast("bigint").alias("footfall"),
        F.round(F.col("reads") / 2, 2).alias("raw_footfall"), whole("visits"), (F.col("stay") / F.col("visits")).alias("avg_stay"),
        F.coalesce("site_status", F.lit("Active")).alias("site_status"), "status_day", whole("pcn_count"), zero("potential_revenue"),
        zero("realised_revenue"), *[whole(c) for c in ("paid_count", "cancelled_count", "appeals_count", "debt_count")],
        zero("debt_receipts"))
