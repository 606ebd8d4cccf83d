"""Time grids, interval splitting and occupancy building blocks.

Grids are generated, never joined: each entity row explodes its own slot
sequence (``explode(sequence(...))``), so a grid is a narrow, per-partition
operation whose output is proportional to entities x slots, with no
cartesian join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def entity_grid(entities: DataFrame, start, stop, step: str, name: str = "slot") -> DataFrame:
    """Every entity row x every point of ``sequence(start, stop, step)``.

    ``start``/``stop`` are columns or values (e.g. scalar sub-queries over the
    facts, per-entity local day bounds); ``step`` an interval literal such as
    ``'15 minutes'`` or ``'1 month'``.
    """
    seq = F.sequence(_c(start) if not isinstance(start, Column) else start,
                     _c(stop) if not isinstance(stop, Column) else stop, F.expr(f"INTERVAL {step}"))
    return entities.select("*", F.explode(seq).alias(name))
