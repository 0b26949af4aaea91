"""Frequent keys in bounded memory."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Items that the sketch of one aggregate tracks at most (a limit of Spark's function).
MOST_TRACKED = 1_000_000


def frequent_keys(
    df: DataFrame, keys: Sequence[str], share: float, count: str = "rows", null_safe: bool = False
) -> DataFrame:
    """Keys that hold at least ``share`` of the rows, with their exact number of rows as ``count``.

    Two passes and no shuffle of all keys. The first keeps a frequent-items
    sketch of the keys' hashes per task and merges them: of fixed size, and
    certain to name every hash with that share. The second counts the rows of
    the few named hashes exactly, combined in the map tasks. Keys with a NULL
    part are left out unless ``null_safe``, but count among the rows only then.
    ``share`` is at least 1 / 100,000.
    """
    if not 1e-5 <= share <= 1:
        raise ValueError("share must be at least 1e-5 and at most 1")
    keyed = df.select(*keys)
    for k in () if null_safe else keys:
        keyed = keyed.filter(F.col(k).isNotNull())
    hashed = keyed.withColumn("_hash", F.xxhash64(*keys))
    # the sketch is wrong by less than half the share, so at most 2 / share hashes can reach it
    tracked = min(MOST_TRACKED, math.ceil(8 / share))
    named, total = hashed.agg(
        F.expr(f"transform(approx_top_k(_hash, {math.ceil(2 / share)}, {tracked}), t -> t.item)"), F.count(F.lit(1))
    ).first()
    spark = df.sparkSession
    candidates = spark.createDataFrame([(h,) for h in named or []], "_hash bigint")
    counts = hashed.join(F.broadcast(candidates), "_hash", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    # decimals: a rounded double could miss a key that is exactly at the share
    return counts.filter(F.col(count) >= F.lit(total) * F.lit(Decimal(str(share)))) if total else counts
