"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.values import key_part


def day_text(col) -> Column:
    """Report day as ISO text (both engines hash the same value)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd")


def site_cols(df, col: str = "ors_id"):
    """Add org / region / site parsed from an ``org#region#site`` key."""
    return df.select("*", key_part(col, 0).alias("org"), key_part(col, 1).alias("region"),
                     key_part(col, 2).alias("site"))


def r6(col) -> Column:
    """Six decimals for order-dependent double sums (both engines agree there)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, 6)
