"""Row-preserving lookups (left outer, many-to-one), their checks and reports."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from landledger.functions.parsing import as_column
from landledger.operators.dedup import hashable_columns
from landledger.session import materialize

# Left rows of a hot key that one shuffle partition takes.
ROWS_PER_SALT = 1_000_000


class SideSize(NamedTuple):
    """What one pass over a lookup table says about it."""

    rows: int
    bytes: int
    surplus: int  # rows beyond the first of their key, NULL keys left out


def measure_side(df: DataFrame, keys: Sequence[Column | str]) -> SideSize:
    """Rows, text bytes and surplus rows per key, from one aggregate job."""
    key_cols = [as_column(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    has_key = reduce(Column.__and__, [F.col(f"_k{i}").isNotNull() for i in range(len(keys))])
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    row = (
        df.select(*key_cols, width.alias("_w"))
        .groupBy(*[f"_k{i}" for i in range(len(keys))])
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_w").alias("_b"))
        .agg(
            F.sum("_n").alias("rows"),
            F.sum("_b").alias("bytes"),
            F.sum(F.when(has_key, F.col("_n") - 1)).alias("surplus"),
        )
        .first()
    )
    return SideSize(row["rows"] or 0, row["bytes"] or 0, row["surplus"] or 0)


def broadcast_within(df: DataFrame, size: SideSize, max_bytes: int = 64 << 20, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only for a side measured to be within both bounds.

    Beyond them the side is returned as it is and Spark shuffles the join.
    """
    return F.broadcast(df) if size.bytes <= max_bytes and size.rows <= max_rows else df


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float, count: str | None = None, null_safe: bool = False
) -> DataFrame:
    """Keys that hold at least ``share`` of the rows; their row number as ``count``.

    By that definition there are at most ``1 / share`` of them, which is the
    size bound for broadcasting the result. Keys with a NULL part are left out
    unless ``null_safe``.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    keyed = df.select(*keys)
    for k in () if null_safe else keys:
        keyed = keyed.filter(F.col(k).isNotNull())
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # decimals: a rounded double could miss a key that is exactly at the share
    floor = keyed.agg((F.count(F.lit(1)) * F.lit(Decimal(str(share)))).alias("_floor")).scalar()
    hot = counts.filter(F.col("_n") >= floor)
    return hot.select(*keys, *[F.col("_n").alias(c) for c in [count] if c])


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | None = None,
    *,
    left_on: Sequence[Column | str] | None = None,
    right_on: Sequence[str] | None = None,
    null_safe: bool = False,
    spread_nulls: bool = True,
    hot_share: float | None = None,
    hot: DataFrame | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
    distinct: bool = False,
    kept: Observation | None = None,
) -> DataFrame:
    """Left outer equi-join that adds the columns of ``right`` and drops its keys.

    ``on`` names keys that both sides share; they come first in the output,
    once. ``left_on``/``right_on`` join differently named or derived keys; the
    output is then the left columns followed by the rest of the right ones.

    A NULL key matches nothing unless ``null_safe``. Left rows with a NULL key
    would all land in one shuffle partition; a hash of the row takes the place
    of one of their key values (of a text or integer column, else it is a salt),
    so they are spread over all partitions. ``hot_share`` finds the keys that
    hold at least that share of the left side, in a job of its own, and gives
    each as many salts as its rows need at ``rows_per_salt`` each; only the
    matching right rows are repeated that often. ``hot`` passes such keys when
    they are known already (:func:`hot_keys` with ``count``: keys in their
    order, then the number of rows). Without either AQE splits skewed partitions
    at run time. Salts depend on the row alone, so that a task that is run again
    sends each row the same way; copies of one row share a salt and are left to
    AQE, or dropped beforehand.

    ``distinct`` first drops left rows that are equal to another in every column.
    Equal rows have equal keys and salts, so they meet in the shuffle that the
    join needs anyway and the left side is not shuffled a second time. ``kept``
    then counts the rows that are left. AQE does not split the partitions of
    such a join: pass ``hot`` where a key holds more rows than a task should.

    No side is broadcast here: Spark does so by its own size estimate, and
    :func:`broadcast_within` adds the hint for a measured side.
    """
    if on is not None:
        left_keys, right_keys = [F.col(k) for k in on], list(on)
    else:
        if not left_on or not right_on or len(left_on) != len(right_on):
            raise ValueError("give either on, or left_on and right_on of equal length")
        left_keys, right_keys = [as_column(k) for k in left_on], list(right_on)
    payload = [c for c in right.columns if c not in right_keys]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}; rename one of them")

    n = len(right_keys)
    lk, rk = [f"_lk{i}" for i in range(n)], [f"_rk{i}" for i in range(n)]
    lhs = left.select("*", *[k.alias(a) for k, a in zip(left_keys, lk, strict=True)])
    rhs = right.withColumnsRenamed(dict(zip(right_keys, rk, strict=True)))

    row_hash = F.expr("xxhash64({})".format(", ".join([*lk, *[f"`{c}`" for c in hashable_columns(left)]])))
    if hot is None and hot_share:
        hot = materialize(hot_keys(lhs, lk, hot_share, "_rows", null_safe), "hot")
    if hot is not None:
        lhs, rhs = _salted(lhs, rhs, hot.toDF(*lk, "_rows"), lk, rk, row_hash, rows_per_salt, null_safe)
    elif spread_nulls and not null_safe:
        lhs, rhs = _nulls_salted(lhs, rhs, lk, rk, row_hash)
    if distinct:
        lhs = _distinct(lhs, [c for c in (*lk, "_ls") if c in lhs.columns])
        if kept is not None:
            lhs = lhs.observe(kept, F.count(F.lit(1)).alias("rows"))
    if null_safe:
        match = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(lk, rk, strict=True)]
    else:
        match = [F.col(a) == F.col(b) for a, b in zip(lk, rk, strict=True)]
    if "_ls" in lhs.columns:
        match.append(F.col("_ls") == F.col("_rs"))
    if "_whole" in lhs.columns:
        match.append(F.col("_whole"))

    joined = lhs.join(rhs, reduce(Column.__and__, match), "left").drop(*lk, *rk, "_ls", "_rs", "_whole")
    if on is not None:
        return joined.select(*on, *[c for c in left.columns if c not in on], *payload)
    return joined


def _distinct(lhs, shuffled):
    """Distinct rows, shuffled and sorted as a join on ``shuffled`` needs them."""
    # a double has one zero, as in a group
    doubles = [f for f in lhs.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    zeros = {f.name: F.col(f"`{f.name}`") + F.lit(0).cast(f.dataType) for f in doubles}
    rest = [c for c in lhs.columns if c not in shuffled]
    copies = Window.partitionBy(*shuffled, *[F.col(f"`{c}`") for c in rest]).orderBy(shuffled[0])
    dealt = lhs.withColumns(zeros).repartition(*shuffled)
    return dealt.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") == 1).drop("_copy")


def _nulls_salted(lhs, rhs, lk, rk, row_hash):
    """Spread the left rows whose key has a NULL part; they match nothing.

    Where a key is text or an integer the hash stands in for its value, and the
    join also asks that the key was whole. The shuffle keys stay those of the
    right side, which need not be shuffled again if it is grouped by them.
    """
    any_null = reduce(Column.__or__, [F.col(a).isNull() for a in lk])
    casts = {"string": row_hash.cast("string"), "bigint": row_hash, "int": F.pmod(row_hash, F.lit(2**31 - 1)).cast("int")}
    kinds = {a: lhs.schema[a].dataType.simpleString() for a in lk}
    chosen = next((a for a in lk if kinds[a] in casts), None)
    if chosen:
        stand_in = F.when(any_null, casts[kinds[chosen]]).otherwise(F.col(chosen))
        return lhs.withColumns({"_whole": ~any_null, chosen: stand_in}), rhs
    # written as hash % 1: Catalyst would fold a literal into a filter on the left
    zero = F.expr("pmod(xxhash64({}), 1L)".format(", ".join(rk)))
    salt = F.when(any_null, row_hash).otherwise(F.lit(0).cast("bigint"))
    return lhs.withColumn("_ls", salt), rhs.withColumn("_rs", zero)


def _salted(lhs, rhs, hot, lk, rk, row_hash, rows_per_salt, null_safe):
    """Spread hot keys over their salts and repeat their right rows; NULL keys by the row hash."""
    salts = F.greatest(F.ceil(F.col("_rows") / rows_per_salt), F.lit(1)).cast("bigint")
    hot = hot.withColumn("_salts", salts).drop("_rows")
    # at most 1 / share rows when found here, measured when passed in
    hot = broadcast_within(hot, measure_side(hot, lk))
    names = {a: f"_h{i}" for i, a in enumerate(lk)}
    renamed = hot.withColumnsRenamed(names)

    def same(keys):
        return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(h)) for k, h in zip(keys, names.values(), strict=True)])

    any_null = reduce(Column.__or__, [F.col(a).isNull() for a in lk])
    spread = F.when(F.col("_salts") > 1, F.pmod(row_hash, F.col("_salts"))).otherwise(F.lit(0).cast("bigint"))
    lhs = lhs.join(renamed, same(lk), "left")
    salt = spread if null_safe else F.when(any_null, row_hash).otherwise(spread)
    lhs = lhs.withColumn("_ls", salt).drop("_salts", *names.values())
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    rhs = rhs.join(renamed, same(rk), "left").withColumn("_rs", F.explode(copies))
    return lhs, rhs.drop("_salts", *names.values())


def remap_keys(df: DataFrame, column: str, mapping: DataFrame, old: str, new: str, out: str) -> DataFrame:
    """Parent key from a mapping table: the mapped value, else the key itself.

    The table form of :func:`landledger.functions.map_key` for large mappings.
    """
    renamed = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = lookup_join(df, renamed, left_on=[column], right_on=["_old"])
    return joined.select(*df.columns, F.coalesce("_new", column).alias(out))


def observe_matches(df: DataFrame, matched: str, name: str) -> tuple[DataFrame, Observation]:
    """Row and match counts of a join, filled by the action that runs it.

    No extra job. Re-run tasks may count twice: for reports, never for gates.
    """
    observation = Observation(name)
    watched = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        F.count(matched).alias("matched"),
        F.count_if(F.col(matched).isNull()).alias("unmatched"),
    )
    return watched, observation


def match_counts(df: DataFrame, matched: str) -> DataFrame:
    """Row and match counts of a join as a one-row relation (exact)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(matched).alias("matched"),
        F.count_if(F.col(matched).isNull()).alias("unmatched"),
    )


def coverage_by_group(df: DataFrame, keys: Sequence[str], matched: str, digits: int = 1) -> DataFrame:
    """Rows, matched rows and percentage per group, lowest coverage first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count(matched).alias("matched"))
    percent = F.round(F.col("matched") / F.col("total") * 100, digits)
    return counts.withColumn("pct", percent).orderBy("pct", *keys)


def colocated_lookup(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """:func:`lookup_join` of two tables that are bucketed by ``on``, without a shuffle.

    Both are written by :func:`landledger.sinks.write_bucketed` with the same
    keys and number of buckets. Left rows with a NULL key match nothing; they
    are read on their own and never enter the join, as their bucket would hold
    them all.
    """
    payload = [c for c in right.columns if c not in on]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}; rename one of them")
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in on])
    matched = left.filter(whole).join(right, list(on), "left")
    order = [*on, *[c for c in left.columns if c not in on]]
    alone = left.filter(~whole).select(*order, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in payload])
    return matched.select(*order, *payload).unionByName(alone)


def key_differences(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that only one side has: ``on``, rows on either side, and ``only_in`` (``left`` or ``right``).

    One aggregate over both sides, combined in the map tasks, so a key of any
    frequency reaches the shuffle once per task. Keys with a NULL part are left out.
    """
    sides = left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    for k in on:
        sides = sides.filter(F.col(k).isNotNull())
    counts = sides.groupBy(*on).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
    only = F.when(F.col("right_rows") == 0, "left").when(F.col("left_rows") == 0, "right")
    return counts.withColumn("only_in", only).filter("only_in IS NOT NULL")


def missing_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks.

    Both sides are reduced to distinct keys first, which the map tasks do in
    part, so a hot key reaches the join once. A NULL key is never missing.
    """
    wanted = left.select(*on)
    for k in on:
        wanted = wanted.filter(F.col(k).isNotNull())
    return wanted.distinct().join(right.select(*on).distinct(), list(on), "left_anti")
