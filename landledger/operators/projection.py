"""Typed projections and filters over whole relations."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions import parsing


def blank_to_null(df: DataFrame, columns: Collection[str]) -> DataFrame:
    """Blank text becomes NULL in ``columns``; other columns pass through."""
    return df.select(*[parsing.blank_to_null(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def cast_fields(
    df: DataFrame,
    strings: Collection[str] = (),
    ints: Collection[str] = (),
    doubles: Collection[str] = (),
    dates: Collection[str] = (),
    nan_to_null: bool = False,
) -> DataFrame:
    """Type an all-string relation in one ``select``.

    Blank text is NULL in every listed column, malformed text is NULL in every
    listed numeric or date column, doubles may use a decimal comma. Column
    order is kept and unlisted columns pass through.
    """

    def double(c: Column) -> Column:
        value = parsing.decimal_comma(c)
        return parsing.finite(value) if nan_to_null else value

    def text(c: Column) -> Column:
        return c.cast("string")

    parsers = {name: text for name in strings}
    parsers |= {name: parsing.parse_int for name in ints}
    parsers |= {name: double for name in doubles}
    parsers |= {name: parsing.parse_date for name in dates}
    unknown = parsers.keys() - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.select(
        *[
            parsers[c](parsing.blank_to_null(c)).alias(c) if c in parsers else F.col(c)
            for c in df.columns
        ]
    )


def project(df: DataFrame, outputs: Mapping[str, Column | str]) -> DataFrame:
    """``{output name: expression or source column}`` as one ``select``."""
    return df.select(*[parsing.as_column(expr).alias(name) for name, expr in outputs.items()])


def with_prefix(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` starts with one of ``prefixes`` (pushed to the scan)."""
    tests = [F.col(column).startswith(p) for p in prefixes]
    return df.filter(reduce(Column.__or__, tests, F.lit(False)))


def with_positive(df: DataFrame, columns: Sequence[str], equals: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with the given category values and with all of ``columns`` present and > 0."""
    tests = [F.col(c) == v for c, v in (equals or {}).items()]
    for c in columns:
        tests += [F.col(c).isNotNull(), F.col(c) > 0]
    return df.filter(reduce(Column.__and__, tests, F.lit(True)))


def with_ratio(df: DataFrame, numerator: str, denominator: str, name: str) -> DataFrame:
    """Add ``numerator / denominator``; callers filter the denominator to > 0."""
    return df.withColumn(name, F.col(numerator) / F.col(denominator))


def round_columns(df: DataFrame, columns: Collection[str], digits: int = 4) -> DataFrame:
    """Round numeric text columns to ``digits``; NULL and blank stay NULL."""
    return df.select(
        *[parsing.round_score(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns]
    )
