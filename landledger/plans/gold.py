"""Sales table to price statistics by commune and by department."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger import publication, sinks, sources
from landledger.operators import rollup
from landledger.plans import property_model as m
from landledger.session import scratch_scope


def price_by_commune(silver: DataFrame) -> DataFrame:
    return rollup.price_rollup(silver, "code_commune", m.PRICE_COLUMNS)


def price_by_department(silver: DataFrame) -> DataFrame:
    return rollup.price_rollup(silver, "code_departement", m.PRICE_COLUMNS)


def split_rollups(both: DataFrame) -> dict[str, DataFrame]:
    """One table per area column from :func:`landledger.operators.rollup.price_rollups`."""
    areas = m.PRICE_COLUMNS.areas
    return {
        area: both.filter(F.col("rollup") == area).drop("rollup", *[a for a in areas if a != area])
        for area in areas
    }


def build_gold(silver: DataFrame) -> dict[str, DataFrame]:
    """Both tables, each a view on one pass over the sales; the medians are searched at once."""
    return split_rollups(rollup.price_rollups(silver, m.PRICE_COLUMNS))


def run_gold(spark: SparkSession, silver_path: str, commune_path: str, department_path: str) -> None:
    """Rebuild both tables in full from one pass.

    Only the finished statistics are kept between the two writes, a few rows
    per area and quarter. Scratch tables are removed at the end.
    """
    silver = sources.scan_table(spark, silver_path, m.PARTITIONS)
    with scratch_scope(spark):
        both = rollup.price_rollups(silver, m.PRICE_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tables = split_rollups(both)
            sinks.overwrite(tables["code_commune"], commune_path)
            sinks.overwrite(tables["code_departement"], department_path)
        finally:
            both.unpersist()


def refresh_gold(
    spark: SparkSession, silver_path: str, sketches_path: str, commune_path: str, department_path: str
) -> list[tuple]:
    """Bring both tables up to date with a published sales table; returns the partitions that were read.

    Counts, sums and quantile sketches by commune, quarter and partition are
    kept as a published table that notes which version of the sales it stands
    for. Only partitions whose files have changed since are read again; the
    others contribute what is kept of them. Both tables are then merged from it
    and published. The lines of a transaction in one commune and on one date
    must lie in one partition, as they do when partitions are year and
    department.
    """
    current = publication.read_version(silver_path)
    if current is None:
        raise ValueError(f"nothing is published at {silver_path}")
    known = publication.read_version(sketches_path)
    since = known.note["silver"] if known else None
    changed = publication.changed_partitions(silver_path, since, current.number)
    if changed or known is None:
        sales = publication.read_published(spark, silver_path, current.number, only=changed)
        sketches = rollup.price_sketches(sales, [*m.PRICE_COLUMNS.areas, *m.PARTITIONS], m.PRICE_COLUMNS)
        publication.publish(sketches, sketches_path, m.PARTITIONS, changed, {"silver": current.number})
    kept = publication.read_published(spark, sketches_path)
    for area, path in zip(m.PRICE_COLUMNS.areas, (commune_path, department_path)):
        publication.publish(rollup.merge_sketches(kept, [area, "quarter"], m.PRICE_COLUMNS), path)
    return changed
