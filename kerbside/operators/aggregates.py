"""Aggregation operators beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def consolidate(df: DataFrame, keys: Sequence[str], start: str, end: str, duration: str | None = None,
                amount: str | None = None, amount_mode: str = "sum",
                extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Segments of one transaction → one row: min start, max end, summed duration.

    Payments are stored as fixed-length pieces; the report wants the whole
    purchase.  ``amount_mode`` is ``"sum"`` (pieces carry shares) or
    ``"max"`` (every piece repeats the total).  A plain hash aggregate:
    partial aggregation runs map-side, so a transaction split into many
    pieces costs one row per input partition in the shuffle.
    """
    aggs = [F.min(start).alias(start), F.max(end).alias(end)]
    if duration:
        aggs.append(F.sum(duration).alias(duration))
    if amount:
        aggs.append((F.sum(amount) if amount_mode == "sum" else F.max(amount)).alias(amount))
    for name, c in (extra or {}).items():
        aggs.append(c.alias(name))
    return df.groupBy(*keys).agg(*aggs)


def pivot_counts(df: DataFrame, keys: Sequence[str], label: str, values: Sequence[str],
                 value: str | None = None) -> DataFrame:
    """Long → wide: one column per label value (count, or sum of ``value``).

    The label values are passed in, so Spark does not run a distinct job to
    discover them; the pivot becomes conditional aggregates in one pass.
    """
    g = df.groupBy(*keys).pivot(label, list(values))
    out = g.count() if value is None else g.sum(value)
    return out.fillna(0, subset=list(values))


def collect_sorted_text(col, sep: str = ",", distinct: bool = False) -> Column:
    """Array aggregate rendered as sorted, joined text (element order is undefined)."""
    c = F.col(col) if isinstance(col, str) else col
    arr = F.collect_set(c) if distinct else F.collect_list(c)
    # no (non-NULL) elements → NULL, like ARRAY_AGG over no rows
    return F.when(F.size(arr) > 0, F.array_join(F.sort_array(arr), sep))
