"""Mix sources to target token weights by entropy balancing.

Each source gets a token target. Among all document rates r_i in [0, cap] that
meet the targets, entropy balancing takes those closest to one copy each in
relative entropy. The dual of that convex problem has one multiplier per
source, and its solution is an exponential tilt: r_i = min(cap, exp(m_s x_i)),
where x_i is the size of document i in units of its source's largest. The
multipliers are found by safeguarded Newton steps, all sources at once; each
step is one aggregate over the (source, size) counts.

Rates become copies by one hash of the document id: copies = floor(rate + u + c).
The offset c is one number per source for its large documents, and then one
for all others, chosen by repeated aggregates (each tries a grid of offsets) so
that the words taken meet the target. Copies are thus a function of the
document's own row and of two numbers per source: nothing is sorted, no group
meets in one task, and reruns agree.

Built-in column functions only. All sums are integers or decimals, so that they
do not depend on the order of their terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.llm.shared import table, word_count
from landledger.operators.dedup import number_rows
from landledger.session import materialize

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2
# A document over this share of its source's target is rounded with the large ones.
LARGE_SHARE = 0.01
GRID, GRID_PASSES = 32, 6
MAX_STEPS, TOLERANCE = 60, 1e-6


def _exact(value: Column) -> Column:
    """A double as a decimal, whose sums do not depend on their order."""
    return value.cast("decimal(38,6)")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """(source, source_size, weight, target) from a table with source and size.

    Sources in code point order, NULL last, take the weights in turn. Shares of
    ``budget`` times all words stop at ``cap`` times the source's words, and
    what is cut is shared again by weight until no source is above.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("largest"))
    sums = sums.select(F.col("source").isNull().alias("unnamed"), "*")
    position = (F.col("position") % len(weights) + 1).cast("int")
    shares = number_rows(sums, ["unnamed", "source"], "position").select(
        "source", "source_size", "largest",
        F.element_at(F.array(*map(F.lit, weights)), position).cast("double").alias("weight"),
    )
    shares = materialize(shares, "shares")
    full = F.col("source_size") * F.lit(cap)
    total = budget * float(shares.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    # The set of capped sources only grows, so this ends after as many rounds as
    # sources at most; only three sums come to the driver.
    level, capped = 0.0, -1
    while True:
        at_cap = F.col("weight") * F.lit(level) >= full if capped >= 0 else F.lit(False)
        words, weight, n = shares.agg(
            F.coalesce(F.sum(F.when(at_cap, full)), F.lit(0)),
            F.coalesce(F.sum(F.when(at_cap, F.lit(0.0)).otherwise(F.col("weight"))), F.lit(0.0)),
            F.count(F.when(at_cap, 1)),
        ).first()
        if n == capped or weight == 0:
            break
        level, capped = (total - float(words)) / weight, n
    target = F.least(full.cast("double"), F.col("weight") * F.lit(level))
    return shares.select("source", "source_size", "largest", "weight", target.alias("target"))


def _tilts(sizes: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """The multiplier of every source: (source, tilt); NULL where no tilt is needed.

    A source whose target is its cap (or nothing) has no finite multiplier and
    keeps rate ``cap`` (or 0).
    """
    groups = sizes.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    inner = targets.filter((F.col("target") > 0) & (F.col("target") < F.col("source_size") * cap))
    x = F.col("size") / F.col("largest")
    groups = materialize(
        groups.join(inner.select(F.col("source").alias("named"), "largest"), F.col("source").eqNullSafe(F.col("named")))
        .select("source", "size", x.alias("x"), (F.col("n") * F.col("size")).alias("words")),
        "groups",
    )
    x_least = groups.groupBy("source").agg(
        F.min("x").alias("x_min"),
        (F.sum(_exact(F.col("words") * F.col("x"))) / F.sum("words")).cast("double").alias("x_mean"),
    )
    ratio = F.log(F.col("target") / F.col("source_size"))
    low = F.when(ratio < 0, ratio / F.col("x_min")).otherwise(0.0)
    high = F.when(ratio < 0, 0.0).otherwise(F.log(F.lit(float(cap))) / F.col("x_min"))
    state = materialize(
        inner.join(x_least.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")))
        .withColumn("low", low)
        .withColumn("high", high)
        .select(
            "source", "target", "low", "high",
            F.least(F.greatest(ratio / F.col("x_mean"), F.col("low")), F.col("high")).alias("tilt"),
        ),
        "tilt",
    )
    for _ in range(MAX_STEPS):
        at = state.withColumnRenamed("source", "named")
        rate = F.exp(F.col("tilt") * F.col("x"))
        open_words = F.when(rate < cap, F.col("words") * rate).otherwise(0.0)
        taken = F.when(rate < cap, F.col("words") * rate).otherwise(F.col("words") * F.lit(float(cap)))
        sums = (
            groups.join(at, F.col("source").eqNullSafe(F.col("named")))
            .groupBy("source")
            .agg(
                *[F.first(c).alias(c) for c in ("target", "low", "high", "tilt")],
                F.sum(_exact(taken)).cast("double").alias("taken"),
                F.sum(_exact(open_words * F.col("x"))).cast("double").alias("slope"),
            )
        )
        over = F.col("taken") > F.col("target")
        newton = F.col("tilt") - (F.col("taken") - F.col("target")) / F.nullif(F.col("slope"), F.lit(0.0))
        moved = (
            sums.withColumn("high", F.when(over, F.col("tilt")).otherwise(F.col("high")))
            .withColumn("low", F.when(over, F.col("low")).otherwise(F.col("tilt")))
            .withColumn("error", F.abs(F.col("taken") - F.col("target")) / F.col("target"))
        )
        inside = newton.isNotNull() & (newton > F.col("low")) & (newton < F.col("high"))
        step = F.when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        tilt = F.when(F.col("error") <= TOLERANCE, F.col("tilt")).otherwise(step)
        state = materialize(moved.select("source", "target", "low", "high", tilt.alias("tilt"), "error"), "tilt")
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("source", "tilt")


def _copies(offset: Column, cap: int) -> Column:
    raw = F.floor(F.col("rate") + F.col("u") + offset)
    return F.least(F.greatest(raw, F.lit(0)), F.lit(cap)).cast("long")


def _offsets(rated: DataFrame, wanted: DataFrame, cap: int) -> DataFrame:
    """(source, offset, taken) so that the words taken come nearest to ``wanted``.

    Words taken never fall as the offset rises. Each pass cuts the interval of
    every source into ``GRID`` parts by one aggregate that tries them all.
    """
    span = cap + 1.0
    state = wanted.select("source", "wanted", F.lit(-span).alias("low"), F.lit(span).alias("high"))
    for _ in range(GRID_PASSES):
        at = state.withColumnRenamed("source", "named")
        part = (F.col("high") - F.col("low")) / GRID
        tried = [F.sum(_copies(F.col("low") + part * k, cap) * F.col("size")) for k in range(GRID + 1)]
        sums = (
            rated.join(at, F.col("source").eqNullSafe(F.col("named")))
            .groupBy("source")
            .agg(*[F.first(c).alias(c) for c in ("wanted", "low", "high")], F.array(*tried).alias("tried"))
        )
        # the last grid point that does not take more than wanted
        fits = F.size(F.filter("tried", lambda t: t <= F.col("wanted")))
        k = F.greatest(F.least(fits - 1, F.lit(GRID - 1)), F.lit(0))
        state = materialize(
            sums.select(
                "source", "wanted",
                (F.col("low") + part * k).alias("low"),
                (F.col("low") + part * (k + 1)).alias("high"),
                F.element_at("tried", k + 1).alias("below"),
                F.element_at("tried", k + 2).alias("above"),
            ),
            "offset",
        )
    nearer_low = F.abs(F.col("below") - F.col("wanted")) <= F.abs(F.col("above") - F.col("wanted"))
    return state.select(
        "source",
        F.when(nearer_low, F.col("low")).otherwise(F.col("high")).alias("offset"),
        F.when(nearer_low, F.col("below")).otherwise(F.col("above")).alias("taken"),
    )


def entropy_mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """Documents with size, source_size, target, rate, copies and taken.

    ``docs`` needs ``doc_id``, ``source`` and ``text``. NULL texts have size 0,
    take no words and keep one copy; a NULL source is a source. Rows that
    repeat a document id share one random number, so equal rows get equal
    copies. A NULL id counts as one id. An empty table gives no rows. Columns
    that clash with the new ones are replaced.
    """
    made = ("size", "source_size", "target", "rate", "copies", "taken")
    docs = docs.drop(*made)
    sizes = materialize(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    targets = materialize(source_targets(sizes, weights, budget, cap), "targets")
    tilts = _tilts(sizes, targets, cap).withColumnRenamed("source", "tilted")
    plan = materialize(
        targets.join(tilts, F.col("source").eqNullSafe(F.col("tilted")), "left").drop("tilted"), "plan"
    )

    def rated(rows: DataFrame, plan: DataFrame) -> DataFrame:
        # one row per source; Spark broadcasts it if its measured size allows
        joined = rows.join(plan.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")))
        tilt = F.exp(F.col("tilt") * F.col("size") / F.col("largest"))
        rate = F.when(F.col("tilt").isNotNull(), F.least(tilt, F.lit(float(cap))))
        rate = F.coalesce(rate, F.when(F.col("target") > 0, F.lit(float(cap))).otherwise(0.0))
        return (
            joined.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(1.0))
            .withColumn("u", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / float(1 << 52))
            .withColumn("large", F.col("size") > F.col("target") * LARGE_SHARE)
            .drop("named")
        )

    # the random numbers live in [0, 1), so an offset of 0 keeps the rate on average
    narrow = materialize(rated(sizes.filter("size > 0"), plan).select("source", "size", "rate", "u", "large"), "rated")
    large = narrow.filter("large")
    ideal = large.groupBy("source").agg(F.sum(_exact(F.col("rate") * F.col("size"))).cast("double").alias("wanted"))
    big = materialize(_offsets(large, ideal, cap), "large")
    big = big.select(F.col("source").alias("big"), F.col("offset").alias("large_offset"), "taken")
    rest = (
        targets.join(big, F.col("source").eqNullSafe(F.col("big")), "left")
        .select("source", (F.col("target") - F.coalesce("taken", F.lit(0))).alias("wanted"))
    )
    small = materialize(_offsets(narrow.filter("NOT large"), rest, cap), "small")
    small = small.select(F.col("source").alias("small"), F.col("offset").alias("small_offset"))
    plan = materialize(
        plan.join(big.drop("taken"), F.col("source").eqNullSafe(F.col("big")), "left")
        .join(small, F.col("source").eqNullSafe(F.col("small")), "left")
        .drop("big", "small"),
        "plan",
    )
    offset = F.coalesce(F.when(F.col("large"), F.col("large_offset")).otherwise(F.col("small_offset")), F.lit(0.0))
    copies = F.when(F.col("size") > 0, _copies(offset, cap)).otherwise(1).cast("long")
    # the document rides in a struct, so that none of its columns meets one of the plan's
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    return (
        rated(docs.select("doc_id", "source", word_count("text").alias("size"), whole), plan)
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("document.*", *made)
    )


def op8_entropy_mix(spark, folder: str) -> DataFrame:
    mixed = entropy_mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
