"""Column expressions that turn raw text into typed values.

All of them are NULL for text that does not parse, whatever the ANSI setting,
and all are built-in expressions that stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    """NULL for empty text and for text of spaces only; else the text as it is."""
    c = as_column(col)
    return F.when(F.trim(c) != "", c)


def parse_int(col: Column | str) -> Column:
    return as_column(col).try_cast("int")


def parse_date(col: Column | str) -> Column:
    return as_column(col).try_cast("date")


def parse_double(col: Column | str) -> Column:
    """Double from text.

    The cast raises and catches an exception for each malformed text, which is
    slow where marks like ``s`` are common. Text without a digit or an ``n``
    (every number has a digit, NaN and infinity an ``n``) never reaches it.
    """
    c = as_column(col)
    return F.when(c.rlike("[0-9nN]"), c.try_cast("double"))


def decimal_comma(col: Column | str) -> Column:
    """Double written with a decimal comma or a decimal point."""
    return parse_double(F.replace(as_column(col), F.lit(","), F.lit(".")))


def finite(col: Column | str) -> Column:
    """NULL for NaN, which would otherwise pass a ``> 0`` filter."""
    c = as_column(col)
    return F.when(~F.isnan(c), c)


def round_score(col: Column | str, digits: int = 4) -> Column:
    """Round numeric text so that jitter in its last digits disappears."""
    return F.round(parse_double(col), digits)
