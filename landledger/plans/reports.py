"""The three dashboard queries over the finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.operators import rollup
from landledger.operators.projection import with_positive, with_ratio
from landledger.plans import property_model as m
from landledger.session import materialize


def price_trend(gold: DataFrame, area: str) -> DataFrame:
    """Median and mean price per surface unit of each area over the quarters."""
    return gold.select(area, "quarter", "median_price_per_sqm", "avg_price_per_sqm").orderBy(area, "quarter")


def transaction_volume(gold: DataFrame, area: str) -> DataFrame:
    """Transactions per area and over all areas, by quarter; the total has a NULL area."""
    return (
        gold.groupingSets([[F.col(area), F.col("quarter")], [F.col("quarter")]], F.col(area), F.col("quarter"))
        .agg(F.sum("nb_transactions").alias("nb_transactions"), F.grouping(area).cast("boolean").alias("is_total"))
        .orderBy("quarter", "is_total", area)
    )


def price_by_energy_label(silver: DataFrame, label: str = "dpe_etiquette_dpe") -> DataFrame:
    """Price per surface unit by energy label, over the single sale lines.

    Lines, not transactions: the label belongs to the building of a line.
    Lines without a label form a group of their own. The few groups are large,
    so their medians are exact ones instead of sketches.
    """
    lines = with_positive(
        silver.select(label, m.PRICE_COLUMNS.category, m.PRICE_COLUMNS.value, m.PRICE_COLUMNS.surface),
        [m.PRICE_COLUMNS.surface, m.PRICE_COLUMNS.value],
        {m.PRICE_COLUMNS.category: m.ORDINARY_SALE},
    )
    priced = materialize(
        with_ratio(lines, m.PRICE_COLUMNS.value, m.PRICE_COLUMNS.surface, rollup.PRICE).select(label, rollup.PRICE), "priced"
    )
    means = priced.groupBy(label).agg(F.count(F.lit(1)).alias("nb_lines"), F.avg(rollup.PRICE).alias(f"avg_{rollup.PRICE}"))
    medians = rollup.exact_medians(priced, [label], rollup.PRICE).withColumnRenamed(label, "_label")
    joined = means.join(medians, F.col(label).eqNullSafe(F.col("_label")))
    return joined.select(label, "nb_lines", f"median_{rollup.PRICE}", f"avg_{rollup.PRICE}").orderBy(
        F.asc_nulls_last(label)
    )
