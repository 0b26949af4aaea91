"""What a price model is prepared and judged with: population, split, as-of values, baseline, errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger.operators.rollup import exact_medians
from landledger.session import materialize

TRAIN, TEST = "train", "test"


def eligible(df: DataFrame, allowed: Mapping[str, Sequence[object]]) -> DataFrame:
    """Rows whose columns hold one of the allowed values each; NULL is not allowed."""
    kept = df
    for column, values in allowed.items():
        kept = kept.filter(F.col(column).isin(list(values)))
    return kept


def chronological_split(df: DataFrame, date: str, test_from: object, until: object = None, name: str = "part") -> DataFrame:
    """Add ``train`` before ``test_from`` and ``test`` from then on (through ``until``); NULL elsewhere."""
    day = F.col(date)
    in_test = day >= F.lit(test_from)
    if until is not None:
        in_test = in_test & (day <= F.lit(until))
    return df.withColumn(name, F.when(day < F.lit(test_from), TRAIN).when(in_test, TEST))


def as_of(
    left: DataFrame, right: DataFrame, key: str, date: str, right_key: str, right_date: str,
    columns: Sequence[str], tie_break: Sequence[str] = (),
) -> DataFrame:
    """Add ``columns`` of the newest right row of the same key that is not after ``date``.

    Equal dates are decided by the largest ``tie_break`` columns. A NULL key or
    date on either side gives no value; every left row is kept once.

    A merge, not a join of dates with dates: both sides are reduced to one row
    per key and date in the map tasks, put in one order, and the last value is
    carried forward to the dates that ask. A key's dates are cut by month, and
    each month hands on one row, so that a key of very many dates is spread.
    """
    order = F.struct(*[F.col(c) for c in tie_break]) if tie_break else F.struct(*[F.col(c) for c in columns])
    dated = right.filter(F.col(right_key).isNotNull() & F.col(right_date).isNotNull())
    newest = dated.groupBy(F.col(right_key).alias("_k"), F.col(right_date).alias("_d")).agg(
        F.max_by(F.struct(*columns), order).alias("_value")
    )
    asked = left.select(F.col(key).alias("_k"), F.col(date).alias("_d")).filter("_k IS NOT NULL AND _d IS NOT NULL").distinct()
    # a date that both has a value and asks sees its own value: it is one row
    dates = newest.withColumn("_asks", F.lit(False)).unionByName(
        asked.withColumn("_asks", F.lit(True)), allowMissingColumns=True
    )
    dates = dates.groupBy("_k", "_d").agg(F.first("_value", ignorenulls=True).alias("_value"), F.max("_asks").alias("_asks"))
    timed = isinstance(dates.schema["_d"].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    dates = dates.withColumn("_month", F.date_trunc("month", "_d") if timed else F.lit(0))
    months = dates.filter("_value IS NOT NULL").groupBy("_k", "_month").agg(F.max_by("_value", "_d").alias("_last"))
    months = months.unionByName(dates.select("_k", "_month").distinct(), allowMissingColumns=True)
    months = months.groupBy("_k", "_month").agg(F.first("_last", ignorenulls=True).alias("_last"))
    earlier = Window.partitionBy("_k").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select("_k", "_month", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    upto = Window.partitionBy("_k", "_month").orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = dates.withColumn("_value", F.last("_value", ignorenulls=True).over(upto)).filter("_asks").join(months, ["_k", "_month"])
    found = merged.select("_k", "_d", F.coalesce("_value", "_before").alias("_value"))
    joined = left.join(found, (F.col(key) == F.col("_k")) & (F.col(date) == F.col("_d")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_value.{c}").alias(c) for c in columns])


def naive_baseline(train: DataFrame, test: DataFrame, area: str, price: str, name: str = "predicted") -> DataFrame:
    """Test rows with the median training price of their area.

    An area without training rows (or a NULL one) gets the median of all
    training rows, and ``<name>_from_area`` is false. Medians are exact lower
    ones; without training rows the prediction is NULL.
    """
    prices = materialize(train.select(area, price), "training")
    by_area = exact_medians(prices.filter(F.col(area).isNotNull()), [area], price).select(
        F.col(area).alias("_area"), F.col(f"median_{price}").alias("_own")
    )
    overall = exact_medians(prices.select(F.lit(0).alias("_all"), price), ["_all"], price).select(f"median_{price}")
    joined = test.join(by_area, F.col(area) == F.col("_area"), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in test.columns],
        F.coalesce(F.col("_own"), overall.scalar()).alias(name),
        F.col("_own").isNotNull().alias(f"{name}_from_area"),
    )


def error_measures(df: DataFrame, actual: str | Column, predicted: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """n, mae, rmse, mape (in percent) and r2 of predictions, from one aggregate.

    Rows without an actual or predicted value do not count. ``mape`` leaves out
    actual values of 0; ``r2`` is NULL if the actual values do not vary.
    """
    y = F.col(actual) if isinstance(actual, str) else actual
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    known = df.filter(y.isNotNull() & p.isNotNull())
    error = p - y
    squares, spread = F.sum(error * error), F.var_pop(y) * F.count(F.lit(1))
    return known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error / F.nullif(y, F.lit(0.0))) * 100).alias("mape"),
        F.when(spread > 0, 1 - squares / spread).alias("r2"),
    )
