"""Keys that were merged more than once: the last parent of each."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from landledger.session import materialize

# Steps that a chain may have; Spark raises beyond them.
MOST_STEPS = 1000


def final_parents(mapping: DataFrame, old: str, new: str, most_steps: int = MOST_STEPS) -> DataFrame:
    """``(old, new, steps, cyclic)`` for every key of ``mapping``: the end of its chain of merges.

    A recursive query follows each key until its parent is no key any more. A
    chain that comes back to one of its own keys has no end: ``cyclic`` is true
    and ``new`` is NULL for every key that leads into it; ``steps`` is then the
    length until the first repeated key. Rows with a NULL key or parent are left
    out. A key must have one parent; several are an error of the data and give
    one row each. The result is a written table, and may go to
    :func:`landledger.operators.lookup.remap_keys` as a mapping of one step.
    """
    spark = mapping.sparkSession
    name = f"merges_{uuid.uuid4().hex}"
    mapping.selectExpr(f"`{old}` AS key", f"`{new}` AS parent").filter("key IS NOT NULL AND parent IS NOT NULL").distinct().createOrReplaceTempView(name)
    limits = {"spark.sql.cteRecursionLevelLimit": str(most_steps), "spark.sql.cteRecursionRowLimit": "-1"}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        walked = spark.sql(f"""
            WITH RECURSIVE walk(start, at, seen, cyclic) AS (
              SELECT key, parent, array(key), key = parent FROM {name}
              UNION ALL
              SELECT w.start, m.parent, array_append(w.seen, w.at), m.parent = w.at OR array_contains(w.seen, m.parent)
              FROM walk w JOIN {name} m ON w.at = m.key WHERE NOT w.cyclic)
            SELECT w.start AS `{old}`, CASE WHEN NOT w.cyclic THEN w.at END AS `{new}`, size(w.seen) AS steps, w.cyclic
            FROM walk w LEFT ANTI JOIN {name} m ON w.at = m.key AND NOT w.cyclic""")
        return materialize(walked, "parents")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.catalog.dropTempView(name)
