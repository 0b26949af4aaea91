"""Column and key profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value (NULL is one), most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(column))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct tuples in order."""
    return df.select(*columns).distinct().orderBy(*columns)


def null_rates(df: DataFrame, digits: int = 1) -> DataFrame:
    """Percentage of NULLs per column, by column name, from one pass."""
    names = sorted(df.columns)
    rates = df.agg(*[F.round(F.avg(F.col(f"`{c}`").isNull().cast("int")) * 100, digits).alias(c) for c in names])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_pct")) for c in names]
    return rates.select(F.inline(F.array(*pairs)))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per non-NULL key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("records"))


def key_multiplicity(df: DataFrame, key: str) -> DataFrame:
    """One row: records, unique keys, keys with several records, largest count.

    Records with a NULL key count as records and as nothing else.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    present = F.col(key).isNotNull()
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("total_records"),
        F.count(key).alias("unique_keys"),
        F.count_if(present & (F.col("_n") > 1)).alias("repeated_keys"),
        F.coalesce(F.max(F.when(present, F.col("_n"))), F.lit(0).cast("bigint")).alias("max_records"),
    )


def most_repeated(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` keys with the most records, ties by key."""
    return key_counts(df, key).orderBy(F.desc("records"), key).limit(n)
