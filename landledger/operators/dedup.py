"""Exact duplicates, distinct keys and the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from landledger.session import materialize


def hashable_columns(df: DataFrame) -> list[str]:
    """Columns that hash and order (maps and variants do neither)."""

    def ok(t: T.DataType) -> bool:
        if isinstance(t, T.ArrayType):
            return ok(t.elementType)
        if isinstance(t, T.StructType):
            return all(ok(f.dataType) for f in t.fields)
        return not isinstance(t, (T.MapType, T.VariantType))

    return [f.name for f in df.schema.fields if ok(f.dataType)]


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One copy of each full row; rows that differ in any column stay.

    Planned as a partial and a final hash aggregate: copies of a hot row
    collapse in the map tasks, before the shuffle.
    """
    return df.dropDuplicates()


def dedup_with_counts(df: DataFrame, name: str = "dedup") -> tuple[DataFrame, Observation, Observation]:
    """Duplicates dropped, with row counts before and after.

    Both counts are filled by whatever action runs the returned relation, so
    they cost no job. Re-run tasks may count twice: use them for reports only.
    """
    before, after = Observation(f"{name}_before"), Observation(f"{name}_after")
    seen = df.observe(before, F.count(F.lit(1)).alias("rows"))
    kept = drop_exact_duplicates(seen).observe(after, F.count(F.lit(1)).alias("rows"))
    return kept, before, after


def dedup_counts(df: DataFrame) -> DataFrame:
    """Exact ``(rows_before, rows_after, removed)``, from one pass."""
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    before = F.coalesce(F.sum("_copies"), F.lit(0).cast("bigint"))
    after = F.count(F.lit(1))
    return copies.agg(
        before.alias("rows_before"), after.alias("rows_after"), (before - after).alias("removed")
    )


def row_fingerprint(columns: Sequence[str]) -> list[Column]:
    """128 bits per row from two chained 64-bit hashes.

    Equal rows have equal fingerprints; the reverse may fail, so fingerprints
    only ever rule duplicates out.
    """
    cols = [F.col(f"`{c}`") for c in columns]
    return [
        F.xxhash64(*cols).alias("_fp_a"),
        F.xxhash64(F.lit("b"), *reversed(cols)).alias("_fp_b"),
    ]


def duplicate_rows(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Surplus copies per ``by`` group: ``(by..., duplicates)``.

    One row without ``by``. Every column is compared in full.
    """
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    surplus = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0).cast("bigint"))
    return copies.groupBy(*by).agg(surplus.alias("duplicates"))


def has_repeated_rows(df: DataFrame) -> bool:
    """Whether two rows may be equal in every column.

    Groups 16-byte fingerprints instead of whole rows. ``False`` is certain,
    because equal rows have equal fingerprints; after ``True`` count the copies
    with :func:`duplicate_rows`, which compares every column.
    """
    prints = df.select(*row_fingerprint(df.columns)).groupBy("_fp_a", "_fp_b").agg(F.count(F.lit(1)).alias("_n"))
    return not prints.filter("_n > 1").isEmpty()


def unique_keys(df: DataFrame, columns: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Distinct key tuples whose ``required`` parts are neither NULL nor empty."""
    kept = df
    for c in required:
        kept = kept.filter(F.col(c) != "")
    return kept.select(*columns).distinct()


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "id", partitions: int | None = None) -> DataFrame:
    """Add dense numbers 0..n-1 in the order of ``order_by`` (which must be unique).

    The rows are range-partitioned and written once, so the partition number
    stored with each row is fixed whatever is recomputed later. Each partition
    is then numbered on its own and shifted by the size of those before it;
    only one row per partition passes through the running total.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_by).withColumn("_part", F.spark_partition_id())
    tagged = materialize(ranged, "numbered")
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # at most n rows, one per range partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part").orderBy(*order_by)
    numbered = tagged.withColumn("_row", F.row_number().over(within))
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + F.col("_row") - 1).alias(name), *df.columns)
    )


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: bool = True,
    keep_null_keys: bool = True,
) -> DataFrame:
    """The row with the largest ``order_by`` values per key, NULLs last.

    Spark pushes the rank limit below the shuffle: every map task passes on at
    most one row per key, so a key that holds a third of the rows costs one row
    per task. ``tie_break`` orders full ties by the remaining columns, which
    keeps the result the same when a lost task is run again.
    """
    order = [F.col(c).desc_nulls_last() for c in order_by]
    if tie_break:
        rest = [c for c in hashable_columns(df) if c not in {*keys, *order_by}]
        order += [F.col(c).desc_nulls_last() for c in rest]
    rows = df
    if not keep_null_keys:
        for k in keys:
            rows = rows.filter(F.col(k).isNotNull())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
