"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def byte_words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased and nothing else changed."""
    return text.encode("utf-8", "replace").lower().split() if text else []


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> Iterator[None]:
    """Hand long values to Python in batches of this many rows and about this size within the block.

    Spark's defaults of 10,000 rows and 64 MB are meant for short rows; a task
    holds several copies of a batch on each side of the pipe.
    """
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def hashed_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those of least hashed key; deterministic.

    Rows that are unlikely to be among them are left out before the ordering,
    so that the tasks hand on about twice as many rows as asked for in all.
    """
    drawn = df.withColumn("_draw", F.pmod(F.xxhash64(key), F.lit(1 << 40)))
    total = max(df.count(), 1)
    likely = drawn.filter(F.col("_draw") <= int((1 << 40) * min(1.0, 2 * most / total + 1000 / total)))
    return likely.orderBy("_draw", key).limit(most).drop("_draw")
