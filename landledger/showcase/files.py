"""Scans and sinks: tables written in raw formats and read back.

All files go to the shared scratch folder of the session.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
import pyarrow as pa
import pyarrow.csv as pc
from pyspark.sql import functions as F

from landledger import sinks, sources
from landledger.functions import decimal_comma
from landledger.operators import nested, projection, snapshot
from landledger.session import scratch_path
from landledger.showcase.registry import comma, query


@query(
    "csv_scan_partitioned",
    """SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
      CAST(year(o_orderdate) AS VARCHAR) AS year, '0' || substr(o_orderpriority, 1, 1) AS department FROM orders""",
)
def csv_scan_partitioned(t):
    """Gzip CSV under Hive-style directories; ``department=01`` stays text."""
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        comma("o_totalprice").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
        "o_orderpriority",
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("0"), F.substring("o_orderpriority", 1, 1)).alias("department"),
    )
    root = scratch_path(t.spark, "csv")
    base = sources.object_path(root, "orders", {"publication": "2026-04"})
    raw.hint("rebalance", "year", "department").write.partitionBy("year", "department").option("header", True).option(
        "compression", "gzip"
    ).csv(base)
    columns = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    scanned = sources.scan_csv(t.spark, base, columns, partitions=["year", "department"])
    typed = projection.cast_fields(
        scanned, strings=["o_orderpriority"], doubles=["o_totalprice"], dates=["o_orderdate"]
    )
    return typed.withColumn("o_orderkey", F.col("o_orderkey").try_cast("bigint"))


@query(
    "csv_scan_plain",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS nation
    FROM supplier""",
)
def csv_scan_plain(t):
    path = scratch_path(t.spark, "csv")
    raw = t.supplier.select("s_suppkey", "s_name", F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("nation"))
    raw.write.option("header", True).option("sep", ";").csv(path)
    return sources.scan_csv(t.spark, path, raw.columns, sep=";")


@query(
    "json_lines_scan",
    """SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
      CASE WHEN event_type <> 'click' THEN props END AS props FROM events""",
)
def json_lines_scan(t):
    """A double field that holds text in some records is NULL there."""
    path = scratch_path(t.spark, "jsonl")
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    quoted = t.events.select(
        "event_id", "event_type", value.alias("value"), F.when(F.col("event_type") != "click", F.col("props")).alias("props")
    )
    sinks.write_jsonl(quoted, path)
    schema = "event_id bigint, event_type string, value string, props string"
    return sources.scan_jsonl(t.spark, path, schema).withColumn("value", F.col("value").try_cast("double"))


@query(
    "json_permissive_scan",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events""",
)
def json_permissive_scan(t):
    """Numbers mixed with text in one field, parsed against a declared double."""
    path = scratch_path(t.spark, "jsonl")
    number = F.col("value").cast("decimal(18,2)").cast("string")
    line = F.concat(
        F.lit('{"event_id": '), "event_id", F.lit(', "value": '),
        F.when(F.col("event_type") == "error", '"missing"').otherwise(number), F.lit("}"),
    )
    t.events.select(line.alias("value")).write.text(path)
    return sources.scan_jsonl(t.spark, path, "event_id bigint, value double")


@query(
    "json_document_scan",
    """SELECT r_name AS region, n_name AS nation, c_custkey AS customer, c_acctbal AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def json_document_scan(t):
    """Snapshots of nations with their customers, one document per file, flattened again."""
    departments = t.nation.select(
        F.col("n_name").alias("nom"), F.col("n_nationkey").alias("code"), F.col("n_regionkey").alias("codeRegion")
    )
    regions = t.region.select(F.col("r_name").alias("nom"), F.col("r_regionkey").alias("code"))
    children = t.customer.select(
        F.col("c_custkey").alias("code"), F.col("c_nationkey").alias("codeDepartement"), F.col("c_acctbal").alias("balance")
    )
    path = scratch_path(t.spark, "documents")
    nested.nest_snapshot(departments, regions, children).write.option("maxRecordsPerFile", 1).json(path)
    schema = """department struct<nom: string, code: int, codeRegion: int>, region struct<nom: string, code: int>,
        communes array<struct<code: bigint, codeDepartement: int, balance: double>>"""
    return nested.flatten(
        sources.scan_json_document(t.spark, path, schema),
        "communes",
        {"customer": "code", "balance": "balance"},
        {"region": "region.nom", "nation": "department.nom"},
    )


def pack_archives(rows):
    """Zip archives of CSV text, one per Arrow batch: ``(content)``."""

    def pack(batches):
        for batch in batches:
            text, archive = io.BytesIO(), io.BytesIO()
            pc.write_csv(batch, text, pc.WriteOptions(delimiter=";"))
            with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
                packed.writestr("readme.txt", "not the member that is asked for")
                packed.writestr("rows.csv", text.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([archive.getvalue()], pa.binary())], names=["content"])

    return rows.mapInArrow(pack, "content binary")


@query("zip_csv_scan", "SELECT p_partkey, p_name, p_retailprice FROM part")
def zip_csv_scan(t):
    raw = t.part.select(
        F.col("p_partkey").cast("string").alias("p_partkey"), "p_name", comma("p_retailprice").alias("p_retailprice")
    )
    rows = sources.read_zip_members(pack_archives(raw), "rows.csv", ["p_partkey", "p_retailprice", "p_name"])
    return rows.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_name",
        decimal_comma("p_retailprice").alias("p_retailprice"),
    )


def put_files(files, folder):
    """Write each row of ``files(path, content)`` as one file; the path may hold folders.

    Written through the store's own interface, from the rows of a small table.
    """
    spark = files.sparkSession
    for row in files.toLocalIterator():
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{row['path']}")
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        stream.write(bytearray(row["content"]))
        stream.close()


@query(
    "zip_file_scan",
    """SELECT CAST(n_nationkey AS VARCHAR) AS key, CASE WHEN n_regionkey <> 1 THEN n_name END AS name,
      CASE WHEN n_regionkey > 1 THEN CAST(n_regionkey AS VARCHAR) END AS region FROM nation""",
)
def zip_file_scan(t):
    """Zipped files with records that end early or have more fields than the header."""
    line = F.when(F.col("n_regionkey") == 0, F.concat_ws(";", "n_nationkey", "n_name"))
    line = line.when(F.col("n_regionkey") == 1, F.concat(F.col("n_nationkey").cast("string"), F.lit(";")))
    line = line.when(F.col("n_regionkey") == 2, F.concat_ws(";", "n_nationkey", "n_name", "n_regionkey", F.lit("more")))
    line = line.otherwise(F.concat_ws(";", "n_nationkey", "n_name", "n_regionkey"))
    texts = t.nation.groupBy("n_regionkey").agg(F.array_join(F.collect_list(line), "\r\n").alias("lines"))

    def pack(batches):
        for batch in batches:
            for region, lines in zip(batch["n_regionkey"], batch["lines"]):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("rows.csv", "key;name;region\r\n" + lines + "\r\n")
                yield pd.DataFrame({"path": [f"region={region}/rows.zip"], "content": [out.getvalue()]})

    folder = scratch_path(t.spark, "zip")
    put_files(texts.mapInPandas(pack, "path string, content binary"), folder)
    return sources.scan_zip_csv(t.spark, f"{folder}/*", "rows.csv", ["key", "name", "region"])


AUDITED = """files AS (
  SELECT n_nationkey AS n, CASE n_regionkey WHEN 0 THEN 'n' || n_nationkey || '.json' WHEN 1 THEN 'n' || n_nationkey || '.csv'
      WHEN 2 THEN 'n' || n_nationkey || '.txt' WHEN 3 THEN 'n' || n_nationkey || '.gz' ELSE 'n' || n_nationkey || '.zip' END AS path,
    CASE WHEN n_regionkey = 0 AND n_nationkey % 2 = 0 THEN '{"a": ' || n_nationkey || '}' WHEN n_regionkey = 1 THEN ''
      ELSE n_name END AS text,
    CASE WHEN n_regionkey = 1 THEN 'empty file' WHEN n_regionkey = 0 AND n_nationkey % 2 = 1 THEN 'not valid JSON'
      WHEN n_regionkey = 3 THEN 'not a valid gzip archive' WHEN n_regionkey = 4 THEN 'not a valid zip archive' ELSE '' END AS reason
  FROM nation)"""


def audited_files(t):
    """One file per nation: JSON documents, empty files, plain texts, and texts that pose as archives."""
    region, key = F.col("n_regionkey"), F.col("n_nationkey")
    suffix = F.element_at(F.array(*map(F.lit, (".json", ".csv", ".txt", ".gz", ".zip"))), region + 1)
    text = F.when((region == 0) & (key % 2 == 0), F.concat(F.lit('{"a": '), key, F.lit("}"))).when(region == 1, "").otherwise(F.col("n_name"))
    folder = scratch_path(t.spark, "audit")
    put_files(t.nation.select(F.concat(F.lit("n"), key, suffix).alias("path"), text.cast("binary").alias("content")), folder)
    audited = sources.audit_files(t.spark, folder)
    return audited.withColumn("path", F.regexp_extract("path", "[^/]+$", 0))


@query(
    "audit_files",
    f"""WITH {AUDITED} SELECT path, CAST(length(text) AS BIGINT) AS size, reason = '' AS is_valid, reason,
      sha256(text) AS sha256 FROM files""",
)
def audit_files(t):
    return audited_files(t)


@query(
    "audited_diff",
    f"""WITH {AUDITED}, stored AS (SELECT path, CASE WHEN n % 3 = 0 THEN sha256(text) ELSE 'old' END AS old FROM files WHERE n % 4 <> 0)
    SELECT path, CASE WHEN reason <> '' THEN 'refused' WHEN old IS NULL THEN 'uploaded' WHEN old = sha256(text) THEN 'skipped'
      ELSE 'changed' END AS status, reason, sha256(text) AS checksum, old AS stored_checksum
    FROM files LEFT JOIN stored USING (path)""",
)
def audited_diff(t):
    audited = audited_files(t)
    n = F.regexp_extract("path", "[0-9]+", 0).cast("int")
    stored = audited.filter(n % 4 != 0).select("path", F.when(n % 3 == 0, F.col("sha256")).otherwise("old").alias("sha256"))
    return snapshot.audited_diff(audited, stored)


@query("table_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def table_scan(t):
    scanned = sources.scan_table(t.spark, f"{t.folder}/orders.parquet")
    return scanned.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query(
    "replace_partitions",
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal,
      c_mktsegment FROM customer""",
)
def replace_partitions(t):
    """One segment is loaded again, twice; the other segments stay."""
    path = scratch_path(t.spark, "replace")
    customers = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    sinks.replace_partitions(customers, path, ["c_mktsegment"])
    again = customers.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    for _ in range(2):
        sinks.replace_partitions(again, path, ["c_mktsegment"])
    return t.spark.read.schema(customers.schema).parquet(path)


@query("overwrite_table", "SELECT s_suppkey, s_name FROM supplier")
def overwrite_table(t):
    path = scratch_path(t.spark, "overwrite")
    sinks.overwrite(t.customer.select("c_custkey", "c_name"), path)
    sinks.overwrite(t.supplier.select("s_suppkey", "s_name"), path)
    return t.spark.read.parquet(path)


@query(
    "write_json_lines",
    """SELECT CASE WHEN o_orderstatus = 'P' THEN '{"key":' || o_orderkey || ',"status":null}'
      ELSE '{"key":' || o_orderkey || ',"status":"' || o_orderstatus || '"}' END AS value FROM orders""",
)
def write_json_lines(t):
    """Fields in name order, nulls kept."""
    path = scratch_path(t.spark, "jsonl")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    sinks.write_jsonl(t.orders.select(status.alias("status"), F.col("o_orderkey").alias("key")), path)
    return t.spark.read.text(path)


@query(
    "audit_contents",
    """SELECT event_id || '.json' AS path, CAST(length(text) AS BIGINT) AS size,
      event_type NOT IN ('error', 'signup') AS is_valid,
      CASE event_type WHEN 'error' THEN 'not valid JSON' WHEN 'signup' THEN 'empty file' ELSE '' END AS reason,
      sha256(text) AS sha256
    FROM (SELECT *, CASE event_type WHEN 'error' THEN substr(props, 1, 5) WHEN 'signup' THEN '' ELSE props END AS text
      FROM events)""",
)
def audit_contents(t):
    text = F.when(F.col("event_type") == "error", F.substring("props", 1, 5)).when(
        F.col("event_type") == "signup", ""
    ).otherwise(F.col("props"))
    files = t.events.select(F.concat("event_id", F.lit(".json")).alias("path"), text.cast("binary").alias("content"))
    return sources.audit_contents(files)
