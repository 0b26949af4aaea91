"""Row-preserving lookups and what is reported about them."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger import functions as lf
from landledger.operators import dedup, lookup, quality
from landledger.showcase.registry import query


def line_totals(t):
    """Lookup side: one row per (order, line number)."""
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("total_quantity"), F.count(F.lit(1)).alias("copies")
    )


def keyed_lines(t):
    """Order lines whose line number is unknown where it was 4."""
    return t.lineitem.select(
        "l_orderkey",
        F.when(F.col("l_linenumber") != 4, F.col("l_linenumber")).alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )


MULTI = """
WITH totals AS (
  SELECT l_orderkey AS k1, {right} AS k2, sum(l_quantity) AS total_quantity, count(*) AS copies
  FROM lineitem GROUP BY 1, 2),
keyed AS (
  SELECT l_orderkey, CASE WHEN l_linenumber <> 4 THEN l_linenumber END AS l_linenumber,
         l_partkey, l_suppkey, l_extendedprice FROM lineitem)
SELECT keyed.*, total_quantity, copies FROM keyed
LEFT JOIN totals ON l_orderkey = k1 AND l_linenumber {test} k2
"""


@query("lookup_join_multi", MULTI.format(right="l_linenumber", test="="))
def lookup_join_multi(t):
    return lookup.lookup_join(keyed_lines(t), line_totals(t), ["l_orderkey", "l_linenumber"])


@query(
    "lookup_join_null_safe",
    MULTI.format(right="CASE WHEN l_linenumber <> 4 THEN l_linenumber END", test="IS NOT DISTINCT FROM"),
)
def lookup_join_null_safe(t):
    nullable = t.lineitem.withColumn("l_linenumber", F.when(F.col("l_linenumber") != 4, F.col("l_linenumber")))
    totals = nullable.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("total_quantity"), F.count(F.lit(1)).alias("copies")
    )
    return lookup.lookup_join(keyed_lines(t), totals, ["l_orderkey", "l_linenumber"], null_safe=True)


@query(
    "lookup_join_renamed",
    """WITH latest AS (SELECT user_id, event_id, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT c_custkey, c_name, event_id, event_type, value FROM customer LEFT JOIN latest ON c_custkey = user_id""",
)
def lookup_join_renamed(t):
    latest = dedup.latest_per_key(t.events, ["user_id"], ["ts", "event_id"])
    return lookup.lookup_join(
        t.customer.select("c_custkey", "c_name"),
        latest.select("user_id", "event_id", "event_type", "value"),
        left_on=["c_custkey"],
        right_on=["user_id"],
    )


@query(
    "lookup_join_single",
    """SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def lookup_join_single(t):
    labels = t.labels.withColumnRenamed("doc_id", "_doc")
    return lookup.lookup_join(t.documents.select("doc_id", "lang", "source"), labels, left_on=["doc_id"], right_on=["_doc"])


DERIVED_RULES = [lf.PrefixRule("NATION_1", "NATION_1"), lf.PrefixRule("NATION_2", "NATION_2")]


@query(
    "lookup_join_derived",
    """WITH areas AS (SELECT n_name, n_regionkey FROM nation)
    SELECT c_custkey, src.n_name AS nation, areas.n_regionkey AS parent_region
    FROM customer JOIN nation src ON c_nationkey = src.n_nationkey
    LEFT JOIN areas ON areas.n_name = CASE WHEN src.n_name LIKE 'NATION_1%' THEN 'NATION_1'
      WHEN src.n_name LIKE 'NATION_2%' THEN 'NATION_2' WHEN src.n_name = 'NATION_5' THEN 'NATION_6'
      ELSE src.n_name END""",
)
def lookup_join_derived(t):
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("nation")
    )
    areas = t.nation.select("n_name", F.col("n_regionkey").alias("parent_region"))
    parent = lf.map_key("nation", DERIVED_RULES, {"NATION_5": "NATION_6"})
    return lookup.lookup_join(customers, areas, left_on=[parent], right_on=["n_name"])


@query(
    "lookup_join_salted",
    """WITH latest AS (SELECT event_type, max(event_id) AS last_event, sum(value) AS total FROM events GROUP BY event_type)
    SELECT event_id, user_id, last_event, round(total, 2) AS total
    FROM events LEFT JOIN latest ON latest.event_type = CASE WHEN events.event_type <> 'view' THEN events.event_type END""",
)
def lookup_join_salted(t):
    """Five keys with a fifth of the rows each, one of them NULL: all salted."""
    side = t.events.groupBy("event_type").agg(
        F.max("event_id").alias("last_event"), F.round(F.sum("value"), 2).alias("total")
    )
    events = t.events.select(
        "event_id", "user_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind")
    )
    joined = lookup.lookup_join(events, side, left_on=["kind"], right_on=["event_type"], hot_share=0.05, rows_per_salt=100)
    return joined.drop("kind")


@query(
    "remap_keys",
    """SELECT event_id, user_id, coalesce(CAST(c_nationkey AS BIGINT), user_id) AS parent
    FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal < 0""",
)
def remap_keys(t):
    mapping = t.customer.filter("c_acctbal < 0").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("parent_key"))
    return lookup.remap_keys(t.events.select("event_id", "user_id"), "user_id", mapping, "c_custkey", "parent_key", "parent")


@query(
    "match_counts",
    """SELECT count(*) AS rows, count(quality) AS matched, count(*) - count(quality) AS unmatched
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def match_counts(t):
    return lookup.match_counts(lookup.lookup_join(t.documents.select("doc_id"), t.labels, ["doc_id"]), "quality")


@query(
    "coverage_by_group",
    """SELECT lang, count(*) AS total, count(quality) AS matched,
      round(count(quality) / count(*) * 100, 1) AS pct
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang""",
)
def coverage_by_group(t):
    labelled = lookup.lookup_join(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])
    return lookup.coverage_by_group(labelled, ["lang"], "quality")


@query(
    "missing_keys",
    "SELECT o_orderkey AS order_key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def missing_keys(t):
    orders = t.orders.select(F.col("o_orderkey").alias("order_key"))
    return lookup.missing_keys(orders, t.lineitem.select(F.col("l_orderkey").alias("order_key")), ["order_key"])


@query(
    "hot_keys",
    """SELECT c_mktsegment FROM customer GROUP BY c_mktsegment
    HAVING count(*) >= 0.2 * (SELECT count(*) FROM customer)""",
)
def hot_keys(t):
    return lookup.hot_keys(t.customer, ["c_mktsegment"], 0.2)


@query(
    "unique_lookup",
    """SELECT '4.2-lines' AS rule_id, 'lines lookup must have one row per key' AS description,
      'HARD FAIL' AS severity, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS violation_count,
      count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS passed FROM lineitem""",
)
def unique_lookup(t):
    return quality.unique_lookup(t.lineitem, ["l_orderkey", "l_linenumber"], "lines")


@query(
    "row_conservation",
    """WITH joined AS (SELECT o_orderkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)
    SELECT '4.2' AS rule_id, 'joins must neither add nor drop rows' AS description, 'HARD FAIL' AS severity,
      (SELECT count(*) FROM joined) - (SELECT count(*) FROM orders) AS violation_count,
      (SELECT count(*) FROM joined) = (SELECT count(*) FROM orders) AS passed""",
)
def row_conservation(t):
    """A lookup with many rows per key: the rule must count the rows it adds."""
    orders = t.orders.select("o_orderkey")
    fanned = lookup.lookup_join(orders, t.lineitem.select("l_orderkey", "l_linenumber"), left_on=["o_orderkey"], right_on=["l_orderkey"])
    return quality.row_conservation(orders, fanned)


@query(
    "lookup_join_salted_null_safe",
    """WITH latest AS (SELECT CASE WHEN event_type <> 'view' THEN event_type END AS kind, max(event_id) AS last_event
      FROM events GROUP BY 1)
    SELECT event_id, last_event FROM events
    LEFT JOIN latest ON kind IS NOT DISTINCT FROM CASE WHEN event_type <> 'view' THEN event_type END""",
)
def lookup_join_salted_null_safe(t):
    """A NULL key that matches, and is hot like the others."""
    kind = F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind")
    side = t.events.select("event_id", kind).groupBy("kind").agg(F.max("event_id").alias("last_event"))
    joined = lookup.lookup_join(
        t.events.select("event_id", kind), side, ["kind"], null_safe=True, hot_share=0.05, rows_per_salt=100
    )
    return joined.drop("kind")
