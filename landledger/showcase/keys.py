"""Duplicates, distinct keys, latest rows, nested values and snapshot comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.operators import dedup, nested, snapshot
from landledger.showcase.registry import query


@query("drop_duplicates_lines", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def drop_duplicates_lines(t):
    return dedup.drop_exact_duplicates(t.lineitem.select("l_orderkey", "l_linenumber"))


@query("drop_duplicates_documents", "SELECT DISTINCT text, lang, source FROM documents")
def drop_duplicates_documents(t):
    return dedup.drop_exact_duplicates(t.documents.select("text", "lang", "source"))


@query(
    "duplicate_rows",
    """WITH copies AS (SELECT lang, text, source, count(*) AS n FROM documents GROUP BY lang, text, source)
    SELECT lang, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM copies GROUP BY lang""",
)
def duplicate_rows(t):
    return dedup.duplicate_rows(t.documents.select("lang", "text", "source"), ["lang"])


@query(
    "dedup_counts",
    """SELECT count(*) AS rows_before, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after,
      count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed FROM lineitem""",
)
def dedup_counts(t):
    pairs = t.lineitem.select("l_orderkey", "l_linenumber")
    return dedup.dedup_counts(pairs)


@query("unique_keys", "SELECT DISTINCT p_brand, p_type, p_size FROM part WHERE p_brand <> 'Brand#7'")
def unique_keys(t):
    raw = t.part.withColumn("p_brand", F.when(F.col("p_brand") != "Brand#7", F.col("p_brand")).otherwise(""))
    return dedup.unique_keys(raw, ["p_brand", "p_type", "p_size"], ["p_brand"])


@query(
    "numbered_keys",
    """SELECT row_number() OVER (ORDER BY l_suppkey, l_partkey) - 1 AS id, l_partkey, l_suppkey
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
)
def numbered_keys(t):
    pairs = dedup.unique_keys(t.lineitem, ["l_partkey", "l_suppkey"], [])
    return dedup.number_rows(pairs, ["l_suppkey", "l_partkey"])


@query(
    "latest_per_key",
    """SELECT event_id, ts, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
)
def latest_per_key(t):
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return dedup.latest_per_key(events, ["user_id"], ["ts", "event_id"])


@query(
    "latest_per_key_null_dates",
    """WITH dated AS (SELECT event_id, user_id, event_type,
        CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS day FROM events)
    SELECT * FROM dated
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY day DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
)
def latest_per_key_null_dates(t):
    dated = t.events.select(
        "event_id",
        "user_id",
        "event_type",
        F.when(F.col("event_type") != "error", F.col("ts").cast("date")).alias("day"),
    )
    return dedup.latest_per_key(dated, ["user_id", "event_type"], ["day", "event_id"])


@query(
    "flatten_nested",
    """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def flatten_nested(t):
    parsed = t.events.select(
        F.struct("event_id", "event_type").alias("event"),
        F.array(F.from_json("props", "k bigint")).alias("items"),
    )
    return nested.flatten(parsed, "items", {"k": "k"}, {"event_id": "event.event_id", "event_type": "event.event_type"})


@query(
    "array_item",
    """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[2] AS DOUBLE) AS second,
      CAST(NULL AS DOUBLE) AS beyond FROM embeddings""",
)
def array_item(t):
    items = {"first": 0, "second": 1, "beyond": 100_000}
    return t.embeddings.select(
        "vec_id", *[nested.array_item("embedding", i).cast("double").alias(n) for n, i in items.items()]
    )


@query("nest_and_flatten", "SELECT r_name, n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def nest_and_flatten(t):
    documents = nested.nest(t.region, t.nation, "r_regionkey", "n_regionkey", "nations", ["n_nationkey"])
    return nested.flatten(
        documents, "nations", {"n_nationkey": "n_nationkey", "n_name": "n_name"}, {"r_name": "r_name"}
    )


def listed(documents, key):
    """Documents as text, to compare them whole: child:balance in the array's order."""
    child = lambda c: F.concat_ws(":", c["c_custkey"], c["c_acctbal"].cast("decimal(18,2)"))
    return documents.select(*key, F.size("customers").alias("n"), F.array_join(F.transform("customers", child), " ").alias("customers"))


CUSTOMER_TEXT = "coalesce(string_agg(c_custkey || ':' || CAST(c_acctbal AS DECIMAL(18,2)), ' ' ORDER BY c_custkey), '') AS customers"


@query(
    "nest_documents",
    f"""SELECT n_name, CAST(count(c_custkey) AS INTEGER) AS n, {CUSTOMER_TEXT}
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def nest_documents(t):
    """One document per parent, whatever its size."""
    return listed(nested.nest(t.nation, t.customer, "n_nationkey", "c_nationkey", "customers", ["c_custkey"]), ["n_name"])


@query(
    "nest_slices",
    f"""SELECT n_name, c_mktsegment AS segment, CAST(count(c_custkey) AS INTEGER) AS n, {CUSTOMER_TEXT}
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment""",
)
def nest_slices(t):
    """One document per parent and slice key of the caller."""
    documents = nested.nest(
        t.nation, t.customer, "n_nationkey", "c_nationkey", "customers", ["c_custkey"], "c_mktsegment", "segment"
    )
    return listed(documents, ["n_name", "segment"])


@query("content_checksum", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_checksum(t):
    return t.documents.select("doc_id", snapshot.content_checksum("text").alias("sha256"))


STATUS = """
SELECT doc_id, sha256(text) AS checksum,
  CASE WHEN source = 'src1' THEN NULL WHEN lang = 'de' THEN sha256(text || '!') ELSE sha256(text) END AS stored_checksum,
  CASE WHEN source = 'src1' THEN 'uploaded' WHEN lang = 'de' THEN 'changed' ELSE 'skipped' END AS status
FROM documents
"""


def document_diff(t):
    """Documents against an older load without one source and with one language altered."""
    incoming = t.documents.select("doc_id", snapshot.content_checksum("text").alias("sha256"))
    old_text = F.when(F.col("lang") == "de", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    stored = t.documents.filter("source <> 'src1'").withColumn("text", old_text)
    stored = stored.select("doc_id", snapshot.content_checksum("text").alias("sha256"))
    return snapshot.diff_snapshots(incoming, stored, ["doc_id"])


@query("diff_snapshots", STATUS)
def diff_snapshots(t):
    return document_diff(t)


@query("to_load", f"SELECT * FROM ({STATUS}) WHERE status <> 'skipped'")
def to_load(t):
    return snapshot.to_load(document_diff(t))
