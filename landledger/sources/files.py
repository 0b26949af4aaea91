"""Scans of raw files and tables.

Raw layouts are Hive-style (``dataset/publication=2026-04/year=2024/...``).
Partition columns are declared as text, so ``department=01`` keeps its zero,
and a filter on them prunes directories before any file is opened.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger import publication

# Asked partitions that are broadcast at most.
MOST_ASKED = 200_000


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def object_path(root: str, dataset: str, partitions: Mapping[str, object], file: str = "") -> str:
    """``root/dataset/key=value/.../file``; missing root or file are left out."""
    parts = [root.rstrip("/"), dataset, *[f"{k}={v}" for k, v in partitions.items()], file]
    return "/".join(p for p in parts if p)


def local_file(root: str, levels: Sequence[object], file: str) -> str:
    """Landing-zone path without key names: ``root/level/.../file``."""
    return "/".join([root.rstrip("/"), *[str(x) for x in levels], file])


def _with_partitions(schema: T.StructType | str, partitions: Sequence[str]) -> T.StructType | str:
    if isinstance(schema, str):
        return ", ".join([schema, *[f"`{p}` string" for p in partitions]])
    return T.StructType([*schema.fields, *text_schema(partitions).fields])


def _base(reader, base_path: str | None):
    return reader.option("basePath", base_path) if base_path else reader


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    sep: str = ",",
    partitions: Sequence[str] = (),
    base_path: str | None = None,
) -> DataFrame:
    """CSV with a header, plain or gzip, every column text.

    Never inferred: identifiers keep leading zeros. A gzip file is one task, so
    parallelism comes from the number of files.
    """
    reader = spark.read.schema(_with_partitions(text_schema(columns), partitions)).option("header", True)
    return _base(reader.option("sep", sep), base_path).csv(path)


def scan_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    partitions: Sequence[str] = (),
    base_path: str | None = None,
) -> DataFrame:
    """JSON lines with a declared schema; values that do not fit become NULL."""
    reader = spark.read.schema(_with_partitions(schema, partitions)).option("mode", "PERMISSIVE")
    return _base(reader, base_path).json(path)


def scan_json_document(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    partitions: Sequence[str] = (),
    base_path: str | None = None,
) -> DataFrame:
    """Files that hold one JSON document each, with a declared schema.

    Declared, because inference omits a field that no document carries and a
    later select of it would fail.
    """
    reader = spark.read.schema(_with_partitions(schema, partitions)).option("multiLine", True)
    return _base(reader, base_path).json(path)


def scan_table(spark: SparkSession, path_or_name: str, partitions: Sequence[str] = ()) -> DataFrame:
    """A Parquet directory or published table (anything with a slash) or a catalog table.

    ``partitions`` names the columns that are directories of a Parquet path.
    They are text, as in the raw scans; Spark would turn ``01`` into 1.
    """
    if "/" not in path_or_name:
        return spark.table(path_or_name)
    if publication.versions(path_or_name):
        return publication.read_published(spark, path_or_name)
    scanned = spark.read.parquet(path_or_name)
    if not partitions:
        return scanned
    inside = T.StructType([f for f in scanned.schema.fields if f.name not in partitions])
    return spark.read.schema(_with_partitions(inside, partitions)).parquet(path_or_name)


def asked_only(scanned: DataFrame, asked: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of the partitions that the table ``asked`` names, known only at run time.

    ``partitions`` are partition columns of ``scanned``. Their values are read
    first and prune its directories before files are opened (dynamic partition
    pruning), where ``asked`` is small enough to be broadcast, which is counted.
    """
    # folders never have an empty name; the comparison tells Catalyst that the side is selective, which <> would not
    chosen = asked.select(*[F.col(p).cast("string").alias(p) for p in partitions]).distinct()
    for p in partitions:
        chosen = chosen.filter(F.col(p) > "")
    small = chosen.limit(MOST_ASKED + 1).count() <= MOST_ASKED
    return scanned.join(F.broadcast(chosen) if small else chosen, list(partitions), "left_semi")


def jdbc_read_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; with a partition column the table is read in parallel."""
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None or num_partitions is None:
            raise ValueError("partition_column needs bounds and num_partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return options


def scan_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A database table; arguments as in :func:`jdbc_read_options`."""
    return spark.read.format("jdbc").options(**jdbc_read_options(**options)).load()
