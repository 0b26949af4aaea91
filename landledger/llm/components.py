"""Connected components of a table of links, and nothing of it on the driver.

Alternates two rewritings of the links. In a *large star* every node hands its
larger neighbours to its smallest neighbour; in a *small star* it hands its
smaller neighbours to the smallest of them. Both keep the components and only
ever point links at smaller nodes, until every node of a component has one
link to its smallest node. Each rewriting is one aggregate (combined in the map
tasks) and one join, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.session import discard, kept, materialize, scratch_scope


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` has a > b. Returns links of the same form."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        # u's larger neighbours go to u's smallest neighbour (or to u itself)
        moved = links.select(F.col("b").alias("a"), F.col("a").alias("other")).join(least, "a")
        return moved.select(F.col("other").alias("a"), F.col("least").alias("b")).distinct()
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a")
    kept = least.select("a", F.col("least").alias("b"))
    passed = moved.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return kept.unionByName(passed).distinct()


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node.

    The result reads one written table. Loops and repeated links are harmless;
    links with a NULL end are ignored. Raises if the links still change after
    ``max_rounds``, of which each more than halves the longest way to a root.
    """
    with scratch_scope(links.sparkSession):
        pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        state, seen = materialize(pairs, "links"), None
        for _ in range(max_rounds):
            before, state = state, materialize(_star(_star(state, large=True), large=False), "links")
            discard(before)
            # two numbers that tell whether the set of links changed
            mark = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
            if mark == seen:
                break
            seen = mark
        else:
            raise RuntimeError(f"components are not settled after {max_rounds} rounds")
        kept(state)
    roots = state.select(F.col("b").alias("node")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
