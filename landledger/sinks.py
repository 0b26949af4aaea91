"""Sinks. Each one is a plain Spark write that can be run again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from landledger.session import remove


def replace_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], owned: Sequence[Sequence[object]] | None = None
) -> None:
    """Replace the partitions that occur in ``df``, leave the others.

    ``owned`` lists partitions (values in the order of ``partitions``) that the
    run answers for: those without a row in ``df`` are removed, so that rows of
    an earlier run do not outlive their source. Running it again gives the same
    table. The rebalance hint groups rows by partition for few files, and lets
    AQE split a partition that is too large for one task. Replacement is per
    partition, not one transaction.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    if owned is None:
        return
    # at most one row per partition of the table
    present = {tuple(map(str, r)) for r in df.select(*partitions).distinct().collect()}
    for values in owned:
        if tuple(map(str, values)) not in present:
            remove(df.sparkSession, "/".join([path.rstrip("/"), *[f"{p}={v}" for p, v in zip(partitions, values)]]))


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a whole table."""
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replace the catalog table ``name`` at ``path`` by ``df`` in ``buckets`` buckets of ``keys``, each sorted by them.

    Tables of equal keys and buckets join on these keys without a shuffle. One
    task writes one file per bucket, so choose buckets by the size of the table.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """JSON lines with sorted field names and explicit nulls; returns the count.

    The count is observed during the write, without a job of its own.
    """
    observation = Observation("write_jsonl")
    rows = df.select(*sorted(df.columns)).observe(observation, F.count(F.lit(1)).alias("rows"))
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)
    return observation.get["rows"]


def write_jdbc(df: DataFrame, url: str, table: str, user: str, password: str, mode: str, driver: str | None = None) -> None:
    """Append to or overwrite a database table; the driver comes with the session."""
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    if driver:
        options["driver"] = driver
    df.write.format("jdbc").options(**options).mode(mode).save()
