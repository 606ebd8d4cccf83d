"""kerbside: visit, notice and permit analytics as Spark DataFrame operators."""

__all__ = ["functions", "operators", "plans", "sources", "session"]
