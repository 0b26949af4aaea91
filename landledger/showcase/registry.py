"""Registry of named queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one scale folder: ``t.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def comma(column: str) -> Column:
    """Two-decimal number as text with a decimal comma, as raw files have it."""
    return F.replace(F.col(column).cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


def shown(column: str) -> Column:
    """A mean rounded for comparison; the shift keeps exact ties off the edge."""
    return F.round(F.col(column) + 1e-7, 4).alias(column)


def shown_means(df: DataFrame) -> DataFrame:
    return df.select(*[shown(c) if c.startswith("avg_") else F.col(c) for c in df.columns])
