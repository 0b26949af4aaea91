"""Every operator as a query over the test tables, with the SQL that checks it."""

from landledger.showcase import (  # noqa: F401  (registration)
    columns,
    evaluation,
    files,
    joins,
    keys,
    ledger,
    prices,
    publishing,
    rules,
    runs,
    sales,
)
from landledger.showcase.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
