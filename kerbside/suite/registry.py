"""Collects the registered queries and their oracle SQL from the suite modules."""

from __future__ import annotations

import functools
import importlib

from pyspark.sql import SparkSession

from kerbside.session import apply_core_conf

MODULES = ("basic", "joins", "aggs", "windows", "functions", "reports_visits", "reports_occupancy",
           "reports_sites", "reports_cases", "reports_permits")

QUERIES: dict = {}
ORACLE: dict = {}


def prepared(fn):
    """Apply the session settings the query relies on before building it."""
    @functools.wraps(fn)
    def run(spark: SparkSession, base: str):
        apply_core_conf(spark)
        return fn(spark, base)
    return run


for _name in MODULES:
    _m = importlib.import_module(f"kerbside.suite.{_name}")
    QUERIES.update({k: prepared(f) for k, f in _m.QUERIES.items()})
    ORACLE.update(_m.ORACLE)


def prepare(spark: SparkSession) -> None:
    """Session settings the queries rely on (UTC zone, ANSI, AQE)."""
    apply_core_conf(spark)
