"""Period labels derived from a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landledger.functions.parsing import as_column


def quarter_label(date: Column | str) -> Column:
    """``2024-Q4``; NULL for a NULL date."""
    d = as_column(date)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def publication_label(date: Column | str) -> Column:
    """The half-yearly issue (April, October) that is current on ``date``.

    Going back three months from April or nine from October lands on January,
    so the issue is the half-year of the date shifted by one quarter.
    """
    shifted = F.add_months(as_column(date), -3)
    month = F.when(F.quarter(shifted) <= 2, F.lit("-04")).otherwise(F.lit("-10"))
    return F.concat(F.year(shifted).cast("string"), month)
