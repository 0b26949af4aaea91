"""Transaction-grain price statistics.

A sale of several lots repeats its full value on every line. Surfaces are
therefore summed and the value is taken once per transaction before any price
per surface unit is computed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.functions.labels import quarter_label
from landledger.operators.projection import with_positive, with_ratio
from landledger.session import materialize

PRICE = "price_per_sqm"
# Items that a stored quantile sketch keeps of a group of any size.
SKETCH_ITEMS = 8192


@dataclass(frozen=True)
class PriceColumns:
    """Names of the columns that the price statistics read."""

    transaction: str
    date: str
    category: str
    sale: str
    value: str
    surface: str
    areas: tuple[str, ...]

    @property
    def grain(self) -> list[str]:
        return [self.transaction, *self.areas, self.date]


def to_transaction_grain(df: DataFrame, keys: Sequence[str], once: str, summed: str) -> DataFrame:
    """One row per transaction: ``once`` taken once, ``summed`` added up.

    ``once`` is equal on all lines of a transaction, so its maximum is the
    value itself and does not depend on row order. Sums are built in the map
    tasks, so a transaction of many lines shuffles as one row per task.
    """
    return df.groupBy(*keys).agg(F.max(once).alias(once), F.sum(summed).alias(summed))


def priced_transactions(df: DataFrame, cols: PriceColumns) -> DataFrame:
    """Ordinary sales at transaction grain with price per surface unit and quarter."""
    sales = with_positive(df, [cols.surface, cols.value], {cols.category: cols.sale})
    grain = to_transaction_grain(sales, cols.grain, cols.value, cols.surface)
    priced = with_ratio(grain, cols.value, cols.surface, PRICE)
    return priced.withColumn("quarter", quarter_label(cols.date))


def price_stats(
    priced: DataFrame, group_by: Sequence[str], cols: PriceColumns, accuracy: int | None = None
) -> DataFrame:
    """Counts, medians and means per group.

    The median is an element of the group (the lower one of two), exact for
    groups of any size (:func:`exact_medians`), for which the measured columns
    are written once. With ``accuracy`` it is found by a mergeable sketch
    instead, lazily and with a rank error of about ``n / accuracy``.
    """
    measured = [PRICE, cols.value]
    counts = [F.count(F.lit(1)).alias("nb_transactions")]
    means = [F.avg(c).alias(f"avg_{c}") for c in (*measured, cols.surface)]
    if accuracy is not None:
        sketched = [F.percentile_approx(c, 0.5, accuracy).alias(f"median_{c}") for c in measured]
        stats = priced.groupBy(*group_by).agg(*counts, *sketched, *means)
    else:
        priced = materialize(priced.select(*group_by, *measured, cols.surface), "priced")
        stats = priced.groupBy(*group_by).agg(*counts, *means)
        # columns of one type are searched together
        for kind in sorted({priced.schema[c].dataType.simpleString() for c in measured}):
            mine = [c for c in measured if priced.schema[c].dataType.simpleString() == kind]
            stats = _with_medians(stats, priced, group_by, mine)
    return stats.select(
        *group_by, "nb_transactions", *[f"{kind}_{c}" for c in measured for kind in ("median", "avg")], f"avg_{cols.surface}"
    )


def _with_medians(stats: DataFrame, priced: DataFrame, group_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``stats`` with the exact medians of ``columns`` per group; NULL is a group like others."""
    items = [F.struct(F.lit(c).alias("_measure"), F.col(c).alias("_value")) for c in columns]
    stacked = priced.select(*group_by, F.inline(F.array(*items)))
    found = exact_medians(stacked, [*group_by, "_measure"], "_value", nan_last=True)
    names = {c: f"_of_{i}" for i, c in enumerate(group_by)}
    medians = found.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(
        *[F.max(F.when(F.col("_measure") == c, F.col("median__value"))).alias(f"median_{c}") for c in columns]
    )
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return stats.join(medians, reduce(Column.__and__, same, F.lit(True)), "left").drop(*names.values())


def price_rollup(df: DataFrame, area: str, cols: PriceColumns, accuracy: int | None = None) -> DataFrame:
    """Price statistics by (area, quarter)."""
    return price_stats(priced_transactions(df, cols), [area, "quarter"], cols, accuracy)


def price_rollups(df: DataFrame, cols: PriceColumns, accuracy: int | None = None) -> DataFrame:
    """Price statistics by (area, quarter) for every area column, from one pass.

    ``rollup`` names the area column a row belongs to; the other area columns
    are NULL. Medians do not add up, so each level is computed from the
    transactions, but the scan and the grain shuffle are shared.
    """
    priced = priced_transactions(df, cols)
    kinds = {a: priced.schema[a].dataType for a in cols.areas}
    levels = [
        F.struct(
            F.lit(area).alias("rollup"),
            *[(F.col(a) if a == area else F.lit(None).cast(kinds[a])).alias(a) for a in cols.areas],
        )
        for area in cols.areas
    ]
    leveled = priced.select(F.inline(F.array(*levels)), "quarter", PRICE, cols.value, cols.surface)
    return price_stats(leveled, ["rollup", *cols.areas, "quarter"], cols, accuracy)


def price_sketches(df: DataFrame, group_by: Sequence[str], cols: PriceColumns, k: int = SKETCH_ITEMS) -> DataFrame:
    """What price statistics need of a part of the sales, by ``group_by`` and quarter, in mergeable form.

    ``group_by`` has the area columns and may have columns of the lines, such as
    the partition, on which all lines of a transaction must agree.
    """
    others = [c for c in group_by if c not in cols.grain]
    sales = with_positive(df, [cols.surface, cols.value], {cols.category: cols.sale})
    grain = to_transaction_grain(sales, [*cols.grain, *others], cols.value, cols.surface)
    priced = with_ratio(grain, cols.value, cols.surface, PRICE).withColumn("quarter", quarter_label(cols.date))
    measured = [PRICE, cols.value, cols.surface]
    return priced.groupBy(*group_by, "quarter").agg(
        F.count(F.lit(1)).alias("nb_transactions"),
        *[F.sum(c).alias(f"sum_{c}") for c in measured],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"sketch_{c}") for c in (PRICE, cols.value)],
    )


def merge_sketches(sketches: DataFrame, group_by: Sequence[str], cols: PriceColumns) -> DataFrame:
    """Price statistics per group from :func:`price_sketches` of its parts; columns as in :func:`price_stats`.

    Counts and means are those of the sales themselves. A median is an element
    of the group, the lower one of two; exact up to the sketch's number of
    items, beyond it within a rank error of about 2 / items.
    """
    merged = sketches.groupBy(*group_by).agg(
        F.sum("nb_transactions").alias("nb_transactions"),
        *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in (PRICE, cols.value, cols.surface)],
        *[F.kll_merge_agg_double(f"sketch_{c}").alias(f"sketch_{c}") for c in (PRICE, cols.value)],
    )

    def median(c):
        return F.kll_sketch_get_quantile_double(f"sketch_{c}", F.lit(0.5)).alias(f"median_{c}")

    def mean(c):
        return (F.col(f"sum_{c}") / F.col("nb_transactions")).alias(f"avg_{c}")

    return merged.select(
        *group_by, "nb_transactions", median(PRICE), mean(PRICE), median(cols.value), mean(cols.value), mean(cols.surface)
    )


def exact_medians(
    df: DataFrame, group_by: Sequence[str], column: str, most: int = 10_000, nan_last: bool = False
) -> DataFrame:
    """Exact lower median of ``column`` per group, for groups of any size.

    Equal values are counted together and written once. Running totals over the
    buckets of a group tell which one holds the median, and that bucket is split
    again until it has at most ``most`` distinct values, which are then ranked.
    The first buckets are steps of 0.1 % in either sign, so that values of all
    magnitudes are told apart; later ones are even steps between the bucket's
    least and largest value. Each round is one aggregate over what is left, and
    a group passes one row per bucket to a task. NULL and NaN are left out; with
    ``nan_last`` NaN counts as the largest value.
    """
    value = F.col(column).cast("double")
    usable = df.filter(F.col(column).isNotNull() & (F.lit(nan_last) | ~F.isnan(value)))
    left = usable.groupBy(*group_by, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    left = materialize(left, "values")
    v = F.col("_v").cast("double")
    step = F.floor(F.log2(F.least(F.abs(v), F.lit(1.7e308))) * 1024) + F.lit(2_000_000)
    bucket = F.when(v > 0, step).when(v < 0, -step).otherwise(F.lit(0).cast("bigint"))
    total = F.sum("_n").over(Window.partitionBy(*group_by))
    wanted, first = F.ceil(total / 2), True
    while True:
        left, largest = _median_bucket(left.withColumn("_bucket", bucket), group_by, wanted, first)
        if largest <= most:
            break
        width = F.col("_high").cast("double") - F.col("_low").cast("double")
        even = F.floor((v - F.col("_low").cast("double")) / F.nullif(width, F.lit(0.0)) * 1024)
        bucket, wanted, first = F.coalesce(even, F.lit(0).cast("bigint")), F.col("_rank"), False
    order = Window.partitionBy(*group_by).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        left.withColumn("_upto", F.sum("_n").over(order))
        .filter("_upto >= _rank")
        .groupBy(*group_by)
        .agg(F.min("_v").alias(f"median_{column}"))
    )


def _median_bucket(values: DataFrame, group_by: Sequence[str], wanted: Column, first: bool):
    """The values of each group's median bucket with the rank wanted in it, and the largest such bucket."""
    sizes = values.groupBy(*group_by, "_bucket").agg(
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_values"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
        *([] if first else [F.first("_rank").alias("_rank")]),
    )
    order = Window.partitionBy(*group_by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sizes.withColumn("_upto", F.sum("_n").over(order)).withColumn("_wanted", wanted)
    chosen = materialize(
        placed.filter((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted"))).select(
            *[F.col(c).alias(f"_t_{c}") for c in group_by], F.col("_bucket").alias("_t_bucket"), "_low", "_high",
            "_values", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_rank"),
        ),
        "medians",
    )
    same = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in group_by] + [F.col("_bucket") == F.col("_t_bucket")]
    kept = values.select(*group_by, "_v", "_n", "_bucket").join(chosen, reduce(Column.__and__, same))
    # values that are one double cannot be told apart by steps; they are ranked as they are
    apart = F.col("_low").cast("double") < F.col("_high").cast("double")
    largest = chosen.filter(apart).agg(F.max("_values")).first()[0] or 0
    return materialize(kept.select(*group_by, "_v", "_n", "_low", "_high", "_rank"), "values"), largest
