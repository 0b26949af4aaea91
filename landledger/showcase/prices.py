"""Transaction-grain statistics over order lines.

An order repeats its total on each line, just as a sale of several lots does.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.operators import profile, projection, rollup
from landledger.showcase.registry import Tables, query, shown_means

COLUMNS = rollup.PriceColumns(
    transaction="sale_id",
    date="sale_date",
    category="category",
    sale="F",
    value="value",
    surface="surface",
    areas=("nation", "region"),
)


def sale_lines(t: Tables):
    """Order lines with the total, date and place of their order: several lots of one sale.

    The small tables are joined first, so that the last shuffle is by order and
    the grain aggregate of the operator reuses it.
    """
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t.orders.join(places, F.col("o_custkey") == F.col("c_custkey"))
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.col("o_orderstatus").alias("category"),
        F.col("o_totalprice").alias("value"),
        F.col("l_quantity").alias("surface"),
        F.col("c_nationkey").alias("nation"),
        F.col("n_regionkey").alias("region"),
    )


LINES = """
lines AS (
  SELECT l_orderkey AS sale_id, CAST(o_orderdate AS DATE) AS sale_date, o_orderstatus AS category,
         o_totalprice AS value, l_quantity AS surface, c_nationkey AS nation, n_regionkey AS region
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""

PRICED = f"""
{LINES},
grain AS (
  SELECT sale_id, nation, region, sale_date, max(value) AS value, sum(surface) AS surface
  FROM lines WHERE category = 'F' AND surface > 0 AND value > 0
  GROUP BY sale_id, nation, region, sale_date),
priced AS (
  SELECT *, value / surface AS price_per_sqm,
         CAST(year(sale_date) AS VARCHAR) || '-Q' || CAST(quarter(sale_date) AS VARCHAR) AS quarter
  FROM grain)
"""

STATS = """
count(*) AS nb_transactions,
quantile_disc(price_per_sqm, 0.5) AS median_price_per_sqm,
round(avg(price_per_sqm) + 1e-7, 4) AS avg_price_per_sqm,
quantile_disc(value, 0.5) AS median_value,
round(avg(value) + 1e-7, 4) AS avg_value,
round(avg(surface) + 1e-7, 4) AS avg_surface
"""


@query(
    "gold_by_nation_quarter",
    f"WITH {PRICED} SELECT nation, quarter, {STATS} FROM priced GROUP BY nation, quarter",
)
def gold_by_nation_quarter(t):
    return shown_means(rollup.price_rollup(sale_lines(t), "nation", COLUMNS))


@query(
    "gold_by_region_quarter",
    f"WITH {PRICED} SELECT region, quarter, {STATS} FROM priced GROUP BY region, quarter",
)
def gold_by_region_quarter(t):
    return shown_means(rollup.price_rollup(sale_lines(t), "region", COLUMNS))


@query(
    "gold_rollups_one_pass",
    f"""WITH {PRICED}
    SELECT CASE WHEN grouping(nation) = 0 THEN 'nation' ELSE 'region' END AS rollup,
           nation, region, quarter, {STATS}
    FROM priced GROUP BY GROUPING SETS ((nation, quarter), (region, quarter))""",
)
def gold_rollups_one_pass(t):
    return shown_means(rollup.price_rollups(sale_lines(t), COLUMNS))


@query(
    "price_stats_by_nation",
    f"WITH {PRICED} SELECT nation, {STATS} FROM priced GROUP BY nation",
)
def price_stats_by_nation(t):
    priced = rollup.priced_transactions(sale_lines(t), COLUMNS)
    return shown_means(rollup.price_stats(priced, ["nation"], COLUMNS))


@query(
    "exact_medians",
    f"""WITH {PRICED}
    SELECT region, quantile_disc(price_per_sqm, 0.5) AS median_price_per_sqm FROM priced GROUP BY region""",
)
def exact_medians(t):
    return rollup.exact_medians(rollup.priced_transactions(sale_lines(t), COLUMNS), ["region"], rollup.PRICE)


@query(
    "priced_transactions",
    f"WITH {PRICED} SELECT sale_id, nation, region, sale_date, value, surface, price_per_sqm, quarter FROM priced",
)
def priced_transactions(t):
    return rollup.priced_transactions(sale_lines(t), COLUMNS)


@query(
    "transaction_grain",
    """SELECT l_orderkey, l_linestatus, max(l_tax) AS l_tax, sum(l_quantity) AS l_quantity
    FROM lineitem GROUP BY l_orderkey, l_linestatus""",
)
def transaction_grain(t):
    return rollup.to_transaction_grain(t.lineitem, ["l_orderkey", "l_linestatus"], "l_tax", "l_quantity")


@query(
    "filter_positive",
    """SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem
    WHERE l_returnflag = 'R' AND l_discount > 0 AND l_tax > 0""",
)
def filter_positive(t):
    kept = projection.with_positive(t.lineitem, ["l_discount", "l_tax"], {"l_returnflag": "R"})
    return kept.select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query(
    "ratio_column",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price
    FROM lineitem WHERE l_quantity > 0""",
)
def ratio_column(t):
    positive = projection.with_positive(t.lineitem, ["l_quantity"])
    return projection.with_ratio(positive, "l_extendedprice", "l_quantity", "unit_price").select(
        "l_orderkey", "l_linenumber", "unit_price"
    )


@query(
    "value_counts",
    'SELECT source, count(*) AS "count" FROM documents GROUP BY source',
)
def value_counts(t):
    return profile.value_counts(t.documents, "source")


@query("distinct_values", "SELECT DISTINCT lang, source FROM documents")
def distinct_values(t):
    return profile.distinct_values(t.documents, ["lang", "source"])


LABELLED = "SELECT d.doc_id, text, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
NULL_RATE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100, 1) AS null_pct FROM joined"
    for c in ["doc_id", "lang", "n_chars", "quality", "source", "text", "toxic"]
)


@query("null_rates", f"WITH joined AS ({LABELLED}) {NULL_RATE_SQL}")
def null_rates(t):
    return profile.null_rates(t.documents.join(t.labels, "doc_id", "left"))


@query(
    "key_multiplicity",
    """WITH counts AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey)
    SELECT CAST(sum(n) AS BIGINT) AS total_records, count(l_partkey) AS unique_keys,
           count(*) FILTER (WHERE n > 1) AS repeated_keys, max(n) AS max_records FROM counts""",
)
def key_multiplicity(t):
    return profile.key_multiplicity(t.lineitem, "l_partkey")


@query(
    "most_repeated",
    """SELECT l_partkey, count(*) AS records FROM lineitem
    GROUP BY l_partkey ORDER BY records DESC, l_partkey LIMIT 10""",
)
def most_repeated(t):
    return profile.most_repeated(t.lineitem, "l_partkey", 10)
