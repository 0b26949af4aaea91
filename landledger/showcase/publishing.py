"""Publication in one switch, raw files by ranges and members, and statistics kept up to date."""

from __future__ import annotations

import io
import uuid
import zipfile

import pyarrow as pa
import pyarrow.compute
import pyarrow.csv as pc
from pyspark.sql import functions as F

from landledger import publication, sources
from landledger.functions import decimal_comma
from landledger.plans import gold
from landledger.session import materialize, scratch_path
from landledger.showcase.registry import comma, query, shown_means
from landledger.showcase.sales import SALES, gold_sql, sales_table
from landledger.sources.stores import file_system


def _orders(t):
    return t.orders.select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").cast("string").alias("year"), F.col("o_orderstatus").alias("status")
    )


@query(
    "publish_one_switch",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 3 ELSE o_totalprice END AS o_totalprice,
      CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderstatus AS status
    FROM orders WHERE NOT (o_orderstatus = 'P' AND year(o_orderdate) = 1996)""",
)
def publish_one_switch(t):
    """A run in which one row of one task fails changes nothing; the next replaces and removes partitions at once."""
    path, keys = scratch_path(t.spark, "published"), ["year", "status"]
    orders = _orders(t)
    publication.publish(orders, path, keys)
    middle = t.orders.agg(F.percentile_approx("o_orderkey", 0.5).alias("k")).first()["k"]
    spoiled = F.when(F.col("o_orderkey") == middle, F.raise_error(F.lit("a task fails in the middle"))).otherwise(F.col("o_totalprice"))
    sorted_orders = orders.repartition(*keys).sortWithinPartitions(*keys, "o_orderkey")
    try:
        # fails while it writes, after other rows of its task
        publication.publish(sorted_orders.withColumn("o_totalprice", spoiled * 2), path, keys, arranged=True)
    except Exception as error:
        if "a task fails in the middle" not in str(error):
            raise
    if publication.versions(path) != [1]:
        raise AssertionError("a failed run has published")
    tripled = orders.filter("status = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 3)
    publication.publish(tripled, path, keys, owned=[("1996", "P"), ("1996", "F")])
    return publication.read_published(t.spark, path)


@query(
    "published_changes",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderstatus AS status, count(*) AS orders_before,
      count(*) FILTER (o_orderkey % 2 = 0) AS orders_after
    FROM orders WHERE o_orderpriority IS NOT NULL AND year(o_orderdate) % 2 = 0 GROUP BY ALL""",
)
def published_changes(t):
    """Partitions that differ between two versions, both of which can be read."""
    path, keys = scratch_path(t.spark, "published"), ["year", "status"]
    orders = _orders(t)
    first = publication.publish(orders, path, keys)
    second = publication.publish(orders.filter("year % 2 = 0 AND o_orderkey % 2 = 0"), path, keys)
    changed = publication.changed_partitions(path, first, second)

    def counts(version, name):
        read = publication.read_published(t.spark, path, version, only=changed)
        return read.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    return counts(first, "orders_before").join(counts(second, "orders_after"), keys, "left").fillna(0, ["orders_after"])


LINE = "l_orderkey || '|' || l_linenumber || '|' || l_returnflag || '|' || CAST(l_quantity AS {whole})"
BLOCK = 10_000


@query(
    "file_blocks",
    f"""WITH lines AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, l_orderkey, l_linenumber, {LINE.format(whole="BIGINT")} AS line
      FROM lineitem WHERE l_shipdate IS NOT NULL),
    files AS (SELECT year, string_agg(line, chr(10) ORDER BY l_orderkey, l_linenumber, line) || chr(10) AS text, count(*) AS lines
      FROM lines GROUP BY year)
    SELECT year, CAST(length(text) AS BIGINT) AS size, lines, CAST(ceil(length(text) / {BLOCK}.0) AS BIGINT) AS blocks,
      true AS is_valid, sha256(text) AS sha256 FROM files""",
)
def file_blocks(t):
    """Texts of many blocks, one per year: lines counted block by block on several tasks, checksums as streams."""
    root = scratch_path(t.spark, "text")
    lines = t.lineitem.filter("l_shipdate IS NOT NULL").select(
        F.year("l_shipdate").alias("year"), "l_orderkey", "l_linenumber", F.expr(LINE.format(whole="BIGINT")).alias("line")
    )
    ordered = lines.repartition("year").sortWithinPartitions("year", "l_orderkey", "l_linenumber", "line")
    ordered.select("year", F.col("line").alias("value")).write.partitionBy("year").text(root)
    year = F.regexp_extract("path", "year=([^/]+)/", 1).alias("year")
    by_block = sources.block_checksums(sources.list_files(t.spark, root), BLOCK)
    counted = by_block.groupBy(year).agg(
        F.sum("length").alias("size"), F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("blocks")
    )
    audited = sources.audit_files(t.spark, root).select(year, F.col("size").alias("whole"), "is_valid", "sha256")
    return counted.join(audited, "year").filter("size = whole").drop("whole")


def write_archives(parts, folder):
    """One zip archive per brand with a member per size, written by tasks; their names."""

    def pack(table: pa.Table) -> pa.Table:
        brand = table.column("p_brand")[0].as_py()
        store, inside = file_system(folder)
        store.create_dir(inside, recursive=True)
        name = f"{inside}/{''.join(c if c.isalnum() else '-' for c in brand or 'none')}.zip"
        draft = f"{name}.{uuid.uuid4().hex}"
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "not a member that is asked for")
            for size in sorted(set(table.column("p_size").to_pylist()), key=str):
                text = io.BytesIO()
                mine = table.filter(pa.compute.equal(table.column("p_size"), size)).drop_columns(["p_brand", "p_size"])
                pc.write_csv(mine, text, pc.WriteOptions(delimiter=";"))
                archive.writestr(f"size-{size}.csv", text.getvalue())
        # whole files only, also where a task is run again
        with store.open_output_stream(draft, compression=None) as out:
            out.write(packed.getvalue())
        store.move(draft, name)
        return pa.table({"name": [name]})

    return materialize(parts.groupBy("p_brand").applyInArrow(pack, "name string"), "names")


@query(
    "zip_members_scan",
    "SELECT p_partkey, p_name, p_retailprice FROM part",
)
def zip_members_scan(t):
    """Archives of many members each; every member is a piece of work of its own."""
    folder = scratch_path(t.spark, "zip")
    raw = t.part.select(
        "p_brand", "p_size", F.col("p_partkey").cast("string").alias("p_partkey"), "p_name", comma("p_retailprice").alias("p_retailprice")
    )
    write_archives(raw, folder)
    members = sources.list_members(sources.list_files(t.spark, folder, "*.zip"), "size-*.csv")
    rows = sources.read_members(members, ["p_partkey", "p_retailprice", "p_name"])
    return rows.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", decimal_comma("p_retailprice").alias("p_retailprice")
    )


CHANGED = f"""{SALES}, changed AS (SELECT * FROM silver
  WHERE NOT (year(date_mutation) = 1997 AND code_departement = '01' AND numero_disposition > 3)
    AND NOT (year(date_mutation) = 1998 AND code_departement = '93'))"""


@query("gold_incremental", gold_sql("code_departement", CHANGED, "changed"))
def gold_incremental(t):
    """Statistics after two partitions changed, from their sales and the kept sketches of all others."""
    sales, kept, communes, departments = (scratch_path(t.spark, n) for n in ("sales", "sketches", "communes", "departments"))
    dated = F.year("date_mutation").cast("string").alias("year")
    # only what the statistics read
    needed = ["id_mutation", "date_mutation", "nature_mutation", "valeur_fonciere", "surface_reelle_bati", "code_commune", "code_departement"]
    whole = sales_table(t).select(*needed, "numero_disposition", dated, F.col("code_departement").alias("department"))
    publication.publish(whole, sales, ["year", "department"])
    gold.refresh_gold(t.spark, sales, kept, communes, departments)
    again = publication.read_published(t.spark, sales, only=[("1997", "01")]).filter("numero_disposition <= 3")
    publication.publish(again, sales, ["year", "department"], owned=[("1997", "01"), ("1998", "93")])
    gold.refresh_gold(t.spark, sales, kept, communes, departments)
    return shown_means(publication.read_published(t.spark, departments))
