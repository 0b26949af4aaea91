"""Rejected values, frequent keys, chains of merged keys, differences of key sets, co-located lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from landledger import sinks
from landledger.operators import chains, frequent, lookup, rejects
from landledger.session import scratch_path
from landledger.showcase.registry import comma, query

TOTAL = "CASE WHEN o_orderstatus = 'P' THEN 'on request' ELSE {total} END"
DAY = """CASE WHEN o_orderpriority LIKE '1%' THEN concat(CAST(year(o_orderdate) AS {text}), '-13-01') WHEN o_orderpriority LIKE '2%' THEN '  '
  ELSE CAST(CAST(o_orderdate AS DATE) AS {text}) END"""
CUSTOMER = "CASE WHEN o_custkey % 10 = 0 THEN concat(CAST(o_custkey % 100 AS {text}), ' bis') ELSE CAST(o_custkey AS {text}) END"


@query(
    "rejected_values",
    f"""WITH raw AS (SELECT o_orderstatus = 'P' AS t, o_orderpriority LIKE '1%' AS d, o_custkey % 10 = 0 AS c,
        {DAY.format(text="VARCHAR")} AS day, {CUSTOMER.format(text="VARCHAR")} AS customer FROM orders)
    SELECT 'total' AS "column", 'on request' AS value, count(*) AS rows FROM raw WHERE t GROUP BY ALL
    UNION ALL SELECT 'day', day, count(*) FROM raw WHERE d GROUP BY ALL
    UNION ALL SELECT 'customer', customer, count(*) FROM raw WHERE c GROUP BY ALL""",
)
def rejected_values(t):
    """Every text that was not blank and becomes NULL, counted by column."""
    raw = t.orders.withColumn("_total", comma("o_totalprice")).select(
        F.expr(TOTAL.format(total="_total")).alias("total"),
        F.expr(DAY.format(text="STRING")).alias("day"),
        F.expr(CUSTOMER.format(text="STRING")).alias("customer"),
        "o_orderstatus",
    )
    return rejects.rejected_values(raw, rejects.parsers(ints=["customer"], dates=["day"], commas=["total"]))


@query(
    "rejected_json",
    """WITH found AS (SELECT CASE event_type WHEN 'error' THEN 'value' WHEN 'signup' THEN '_corrupt_record' ELSE 'user_id' END AS "column",
        CASE event_type WHEN 'error' THEN '"missing"' WHEN 'signup' THEN '{"user_id": ' || user_id % 5
          ELSE '{"id":' || user_id % 7 || '}' END AS value
      FROM events WHERE event_type IN ('error', 'signup', 'view'))
    SELECT "column", value, count(*) AS rows FROM found GROUP BY ALL""",
)
def rejected_json(t):
    """JSON lines: broken ones, and fields whose value does not fit the declared type."""
    user = F.when(F.col("event_type") == "view", F.concat(F.lit('{"id": '), F.col("user_id") % 7, F.lit("}"))).otherwise(
        F.col("user_id").cast("string")
    )
    value = F.when(F.col("event_type") == "error", '"missing"').when(F.col("event_type") == "click", "null").otherwise("1.5")
    line = F.concat(F.lit('{"user_id": '), user, F.lit(', "value": '), value, F.lit(', "more": [1]}'))
    line = F.when(F.col("event_type") == "signup", F.concat(F.lit('{"user_id": '), F.col("user_id") % 5)).otherwise(line)
    path = scratch_path(t.spark, "jsonl")
    t.events.select(line.alias("value")).write.text(path)
    schema = t.spark.createDataFrame([], "user_id bigint, value double").schema
    return rejects.rejected_json(t.spark.read.text(path), schema)


@query(
    "frequent_keys",
    """SELECT l_linenumber, l_returnflag, count(*) AS rows FROM lineitem GROUP BY ALL
    HAVING count(*) >= (SELECT count(*) FROM lineitem) * 0.0478""",
)
def frequent_keys(t):
    return frequent.frequent_keys(t.lineitem, ["l_linenumber", "l_returnflag"], 0.0478)


MERGES = """SELECT c_custkey AS old, CASE WHEN c_custkey % 97 = 1 THEN c_custkey + 1 WHEN c_custkey % 97 = 2 THEN c_custkey - 1
    ELSE {third} END AS new FROM customer WHERE c_custkey >= 3 AND (c_custkey % 5 <> 0 OR c_custkey % 97 IN (1, 2))"""


@query(
    "final_parents",
    f"""WITH RECURSIVE merges AS ({MERGES.format(third="c_custkey // 3")}), walk(start, here, seen, cyclic) AS (
      SELECT old, new, [old], old = new FROM merges
      UNION ALL SELECT start, new, list_append(seen, here), new = here OR list_contains(seen, new)
      FROM walk JOIN merges ON here = old WHERE NOT cyclic)
    SELECT start AS old, CASE WHEN NOT cyclic THEN here END AS new, CAST(len(seen) AS INTEGER) AS steps, cyclic FROM walk
    WHERE cyclic OR here NOT IN (SELECT old FROM merges)""",
)
def final_parents(t):
    """Keys merged again and again, some of them in circles."""
    t.customer.createOrReplaceTempView("customer")
    return chains.final_parents(t.spark.sql(MERGES.format(third="c_custkey div 3")), "old", "new")


@query(
    "remap_chains",
    f"""WITH RECURSIVE merges AS ({MERGES.format(third="c_custkey // 3")}), walk(start, here, seen, cyclic) AS (
      SELECT old, new, [old], old = new FROM merges
      UNION ALL SELECT start, new, list_append(seen, here), new = here OR list_contains(seen, new)
      FROM walk JOIN merges ON here = old WHERE NOT cyclic)
    SELECT o_orderkey, o_custkey, coalesce(here, o_custkey) AS parent
    FROM orders LEFT JOIN (SELECT start, here FROM walk WHERE NOT cyclic AND here NOT IN (SELECT old FROM merges)) ON o_custkey = start""",
)
def remap_chains(t):
    """Orders under the last parent of their customer; customers in a circle keep their key."""
    t.customer.createOrReplaceTempView("customer")
    parents = chains.final_parents(t.spark.sql(MERGES.format(third="c_custkey div 3")), "old", "new")
    return lookup.remap_keys(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", parents, "old", "new", "parent")


@query(
    "key_differences",
    """SELECT coalesce(a.k, b.k) AS key, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
      CASE WHEN b.k IS NULL THEN 'left' ELSE 'right' END AS only_in
    FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0 GROUP BY ALL) a
    FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 = 0 GROUP BY ALL) b USING (k)
    WHERE a.k IS NULL OR b.k IS NULL""",
)
def key_differences(t):
    some = t.orders.filter("o_orderkey % 3 = 0").withColumnRenamed("o_custkey", "key")
    return lookup.key_differences(some.filter("o_orderstatus = 'F'"), some.filter("o_orderstatus = 'O'"), ["key"])


def bucketed_sides(t, buckets: int = 8):
    """Orders, some without a customer, and customers, as tables bucketed by customer."""
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("custkey")
    sides = {
        "orders": t.orders.select("o_orderkey", key, "o_totalprice"),
        "customers": t.customer.filter("c_mktsegment <> 'FURNITURE'").select(F.col("c_custkey").alias("custkey"), "c_name", "c_nationkey"),
    }
    for name, df in sides.items():
        table = f"{name}_{uuid.uuid4().hex}"
        sinks.write_bucketed(df, table, scratch_path(t.spark, name), ["custkey"], buckets)
        sides[name] = t.spark.table(table)
    return sides["orders"], sides["customers"]


@query(
    "lookup_join_colocated",
    """SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS custkey, o_orderkey, o_totalprice, c_name, c_nationkey
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment <> 'FURNITURE' AND o_orderstatus <> 'P'""",
)
def lookup_join_colocated(t):
    """Both sides published by customer, so that the lookup shuffles nothing."""
    orders, customers = bucketed_sides(t)
    return lookup.colocated_lookup(orders, customers, ["custkey"])
