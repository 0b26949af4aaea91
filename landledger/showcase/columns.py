"""Text rendered from the tables and parsed back; labels and key mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger import functions as lf
from landledger.operators import projection
from landledger.showcase.registry import comma, query


def raw_lines(t):
    """Order lines as raw text; line 3 is blank, line 5 is suppressed."""
    blanked = F.when(F.col("l_linenumber") == 3, "  ").when(F.col("l_linenumber") == 5, "s")
    return t.lineitem.select(
        F.lpad(F.col("l_orderkey").cast("string"), 9, "0").alias("id"),
        F.lpad(F.col("l_linenumber").cast("string"), 6, "0").alias("line"),
        blanked.otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        blanked.otherwise(comma("l_extendedprice")).alias("price"),
        blanked.otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("shipped"),
        F.when(F.col("l_linenumber") == 3, "").otherwise(F.col("l_returnflag")).alias("flag"),
    )


ID = "lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS id, lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS line"


@query(
    "blank_to_null",
    f"""SELECT {ID},
      CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 5 THEN 's'
           ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
      CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS flag
    FROM lineitem""",
)
def blank_to_null(t):
    return projection.blank_to_null(raw_lines(t).select("id", "line", "quantity", "flag"), ["quantity", "flag"])


@query(
    "parse_types",
    f"""SELECT {ID},
      CASE WHEN l_linenumber NOT IN (3, 5) THEN CAST(l_quantity AS INTEGER) END AS quantity,
      CASE WHEN l_linenumber NOT IN (3, 5) THEN CAST(l_quantity AS INTEGER)::DOUBLE END AS quantity_double,
      CASE WHEN l_linenumber NOT IN (3, 5) THEN CAST(l_shipdate AS DATE) END AS shipped
    FROM lineitem""",
)
def parse_types(t):
    return projection.project(
        raw_lines(t),
        {
            "id": "id",
            "line": "line",
            "quantity": lf.parse_int("quantity"),
            "quantity_double": lf.parse_double("quantity"),
            "shipped": lf.parse_date("shipped"),
        },
    )


@query(
    "decimal_comma",
    f"SELECT {ID}, CASE WHEN l_linenumber NOT IN (3, 5) THEN l_extendedprice END AS price FROM lineitem",
)
def decimal_comma(t):
    return raw_lines(t).select("id", "line", lf.decimal_comma("price").alias("price"))


@query(
    "cast_fields",
    """SELECT lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS id, l_linenumber AS line,
      CASE WHEN l_linenumber NOT IN (3, 5) THEN CAST(l_quantity AS INTEGER) END AS quantity,
      CASE WHEN l_linenumber NOT IN (3, 5) THEN l_extendedprice END AS price,
      CASE WHEN l_linenumber NOT IN (3, 5) THEN CAST(l_shipdate AS DATE) END AS shipped,
      CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS flag
    FROM lineitem""",
)
def cast_fields(t):
    return projection.cast_fields(
        raw_lines(t), strings=["id", "flag"], ints=["line", "quantity"], doubles=["price"], dates=["shipped"]
    )


@query(
    "prefix_filter",
    "SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#22%'",
)
def prefix_filter(t):
    return projection.with_prefix(t.part.select("p_partkey", "p_brand", "p_type"), "p_brand", ["Brand#1", "Brand#22"])


@query(
    "round_columns",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value, 1) END AS score,
      round(value / 7, 4) AS share FROM events""",
)
def round_columns(t):
    raw = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", "").otherwise(F.col("value").cast("string")).alias("score"),
        (F.col("value") / 7).cast("string").alias("share"),
    )
    return projection.round_columns(projection.round_columns(raw, ["score"], 1), ["share"], 4)


@query(
    "quarter_label",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
    FROM orders""",
)
def quarter_label(t):
    return t.orders.select("o_orderkey", lf.quarter_label(F.col("o_orderdate").cast("date")).alias("quarter"))


@query(
    "publication_label",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) >= 10 THEN CAST(year(o_orderdate) AS VARCHAR) || '-10'
        WHEN month(o_orderdate) >= 4 THEN CAST(year(o_orderdate) AS VARCHAR) || '-04'
        ELSE CAST(year(o_orderdate) - 1 AS VARCHAR) || '-10' END AS publication
    FROM orders""",
)
def publication_label(t):
    return t.orders.select("o_orderkey", lf.publication_label(F.col("o_orderdate").cast("date")).alias("publication"))


@query(
    "map_key",
    """SELECT c_custkey, CASE WHEN c_name LIKE 'Customer#00000000%' THEN 'first ten'
        WHEN c_name LIKE 'Customer#0000001%' THEN 'next block'
        WHEN c_name = 'Customer#000000042' THEN 'the answer' ELSE c_name END AS parent FROM customer""",
)
def map_key(t):
    rules = [lf.PrefixRule("Customer#00000000", "first ten"), lf.PrefixRule("Customer#0000001", "next block")]
    return t.customer.select("c_custkey", lf.map_key("c_name", rules, {"Customer#000000042": "the answer"}).alias("parent"))
