"""Transaction analytics on Spark: typed scans, row-preserving enrichment,
declarative quality rules and transaction-correct price statistics."""

__version__ = "0.1.0"
