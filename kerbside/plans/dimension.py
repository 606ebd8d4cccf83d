"""The site dimension: the newest version of each site from the action log, attached to reports by key parts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators import windows as W
from kerbside.plans.sites import current_sites

PARTS = ("organization", "parent", "group_id")


def site_dimension(log: DataFrame, at=None, zones: DataFrame | None = None, extra=()) -> DataFrame:
    """Current sites: organization, parent, group_id, name (and the organisation's ``timezone`` from ``zones``).

    The rows at each key's newest 'site' time, ties kept, deleted ones gone, equal ones once.  With ``at``
    (a timestamp) the sites as they stood then: later log rows do not count.  ``extra`` names more columns.
    """
    if at is not None:
        log = log.where(F.col("timestamp") <= F.lit(at).cast("timestamp_ntz"))
    out = current_sites(log).select(*PARTS, "name", *extra).distinct()
    if zones is None:
        return out
    return out.join(zones.select(F.col("org").alias("organization"), "timezone"), "organization", "left")


def newest_names(log: DataFrame, key: str = "group_id") -> DataFrame:
    """One name per ``key``: that of its newest log row of any kind (greatest name at equal times)."""
    new = W.latest_by_key(log.select(key, "timestamp", "name"), key, "timestamp", tiebreak="name")
    return new.select(key, F.col("name").alias("site_name"))


def with_site(df: DataFrame, sites: DataFrame, parts: Mapping[str, Column], how: str = "left") -> DataFrame:
    """``df`` with ``site_name`` (and ``site_zone`` if the dimension has zones): ``parts`` gives ``df``'s
    expression for each key part of the dimension.

    ``left`` keeps rows without a site, ``inner`` drops them.  The dimension is left to the planner: broadcast
    below its size threshold, else joined by shuffle on the parts.
    """
    named = {c: f"__{c}" for c in parts}
    dim = sites.select(*[F.col(c).alias(f"__d{c}") for c in parts], F.col("name").alias("site_name"),
                       *([F.col("timezone").alias("site_zone")] if "timezone" in sites.columns else []))
    left = df.select("*", *[e.alias(named[c]) for c, e in parts.items()])
    cond = [left[named[c]] == dim[f"__d{c}"] for c in parts]
    return left.join(dim, cond, how).drop(*named.values(), *[f"__d{c}" for c in parts])


def key_parts(col: str, sep: str = "#") -> dict[str, Column]:
    """The dimension's parts from a composite ``organization#parent#group`` key (missing parts NULL)."""
    from kerbside.functions.values import key_part
    return {c: key_part(col, i) for i, c in enumerate(PARTS)}
