"""Whole runs: raw files of several years and departments, gate, publication, statistics.

The raw layout is written from the test tables, then the production entry points
run over it and the published tables are read back.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from landledger import publication, sources
from landledger.operators.quality import QualityGateError
from landledger.plans import gold, silver
from landledger.plans import property_model as m
from landledger.session import materialize, remove, scratch_path, scratch_scope
from landledger.showcase.files import put_files
from landledger.showcase.registry import Tables, query, shown_means
from landledger.showcase.sales import (
    FILLED,
    SALES,
    gold_sql,
    raw_addresses,
    raw_energy,
    raw_incomes,
    raw_sales,
    raw_snapshot,
)

PUBLICATION, EXTRACTED = "2026-04", "2026-09-17"


def clean_sales(t: Tables):
    """Sale lines that no blocking rule refuses, with their partition."""
    known = "type_local IS NULL OR type_local <> 'Garage'"
    kept = raw_sales(t).filter("nature_mutation <> 'Don'").filter(known).filter("code_commune NOT IN ('01023', '01024')")
    return kept.withColumns({"year": F.expr("year(to_date(date_mutation))"), "department": F.col("code_departement")})


def sales_folder(root: str, keys: dict) -> str:
    return sources.object_path(root, m.SALES, {"publication": PUBLICATION, **keys})


def write_sales(lines, root: str) -> None:
    """Gzip CSV by year and department, written by all tasks at once."""
    rows = lines.hint("rebalance", *m.PARTITIONS).write.partitionBy(*m.PARTITIONS)
    rows.option("header", True).option("compression", "gzip").csv(sales_folder(root, {}))


def rewrite_sales(lines, root: str, year: int, department: str) -> None:
    """One partition again, as an empty one if there are no lines."""
    mine = lines.filter((F.col("year") == year) & (F.col("department") == department)).drop(*m.PARTITIONS)
    path = sales_folder(root, {"year": year, "department": department})
    mine.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def write_layout(t: Tables, root: str):
    """Every dataset written once, by partition; the layout, the table of partitions that hold sales, and the sale lines."""
    lines = materialize(clean_sales(t), "lines")
    write_sales(lines, root)
    asked = materialize(lines.select(*m.PARTITIONS).distinct(), "asked")
    department = F.substring("code_commune", 1, 2)
    # every year geocodes the addresses of its department
    addresses = raw_addresses(t).withColumn("department", department).join(asked, "department")
    folder = sources.object_path(root, m.ADDRESSES, {"publication": PUBLICATION})
    # dealt evenly: a writer sorts what it has by partition, and a small file of customers is one task's
    addresses = addresses.hint("rebalance", *m.PARTITIONS, "id").write.partitionBy(*m.PARTITIONS)
    addresses.option("header", True).option("compression", "gzip").csv(folder)
    places = raw_addresses(t).select(F.col("result_id").alias("identifiant_ban"), department.alias("department"))
    energy = raw_energy(t).join(places.filter("identifiant_ban IS NOT NULL"), "identifiant_ban", "left").fillna("01", ["department"])
    energy = energy.hint("rebalance", "department", "numero_dpe")
    folder = sources.object_path(root, m.ENERGY, {"extraction_date": EXTRACTED})
    energy.write.partitionBy("department").option("compression", "gzip").json(folder)
    documents = raw_snapshot(t).withColumn("_department", F.col("department.code"))
    documents = documents.withColumnRenamed("department", "nested").withColumnRenamed("_department", "department")
    # the folder is called like the document's own field
    for d in [r["department"] for r in asked.select("department").distinct().collect()]:
        mine = documents.filter(F.col("department") == d).drop("department").withColumnRenamed("nested", "department")
        mine.write.json(sources.object_path(root, m.SNAPSHOTS, {"extraction_date": EXTRACTED, "department": d}))
    columns = [m.INCOME_KEY, *m.INCOME_INTS, *m.INCOME_DOUBLES]

    def pack(batches):
        text = pd.concat(batches)[columns].to_csv(sep=";", index=False)
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr(m.INCOME_MEMBER, text)
        yield pd.DataFrame({"path": [m.INCOME_ARCHIVE], "content": [out.getvalue()]})

    put_files(raw_incomes(t).coalesce(1).mapInPandas(pack, "path string, content binary"), root)
    return silver.RawLayout(root, PUBLICATION, EXTRACTED, EXTRACTED), asked, lines


def quiet(line: str) -> None:
    """The runs of the queries print nothing."""


def published(t: Tables, one_switch: bool = True) -> str:
    """All partitions that occur published, then one of them again after its raw file has shrunk; raw files are removed."""
    root, target = scratch_path(t.spark, "raw"), scratch_path(t.spark, "silver")
    with scratch_scope(t.spark):
        layout, asked, lines = write_layout(t, root)
        silver.run_silver(t.spark, layout, target, show=quiet, asked=asked, one_switch=one_switch)
        rewrite_sales(lines.filter("numero_disposition <= '000003'"), root, 1997, "01")
        again = asked.filter("year = 1997 AND department = '01'")
        silver.run_silver(t.spark, layout, target, hot_share=0.2, show=quiet, asked=again, one_switch=one_switch)
    remove(t.spark, root)
    return target


RUN = f"""{SALES},
published AS (
  SELECT *, CAST(year(date_mutation) AS VARCHAR) AS year, code_departement AS department FROM silver
  WHERE nature_mutation <> 'Don' AND type_local IS DISTINCT FROM 'Garage' AND code_commune NOT IN ('01023', '01024')
    AND NOT (year(date_mutation) = 1997 AND code_departement = '01' AND numero_disposition > 3))
"""


@query("silver_run", f"WITH {RUN} SELECT * FROM published")
def silver_run(t):
    """Every year and department, replaced partition by partition."""
    target = published(t, one_switch=False)
    return sources.scan_table(t.spark, target, m.PARTITIONS).select(*FILLED, *m.PARTITIONS)


@query("gold_run", gold_sql("code_departement", RUN, "published"))
def gold_run(t):
    """Every year and department, published in one switch and rolled up."""
    target = published(t)
    communes, departments = (scratch_path(t.spark, "gold") for _ in range(2))
    gold.run_gold(t.spark, target, communes, departments)
    return shown_means(sources.scan_table(t.spark, departments))


@query(
    "gate_run",
    f"""WITH {RUN}, asked AS (SELECT DISTINCT year, department, r AS rule_id FROM published, (VALUES ('5-Filosofi'), ('5-geo')) c(r))
    SELECT year, department, rule_id, CAST(0 AS BIGINT) AS violation_count FROM asked
    WHERE year = '1997' AND department = '93'""",
)
def gate_run(t):
    """A partition whose raw file has become empty stops the whole run."""
    root, target = scratch_path(t.spark, "raw"), scratch_path(t.spark, "silver")
    with scratch_scope(t.spark):
        layout, asked, lines = write_layout(t, root)
        rewrite_sales(lines.filter("false"), root, 1997, "93")
        try:
            silver.run_silver(t.spark, layout, target, show=quiet, asked=asked, one_switch=True)
            failed = []
        except QualityGateError as error:
            failed = [(r["year"], r["department"], r["rule_id"], r["violation_count"]) for r in error.failed]
    remove(t.spark, root)
    if publication.versions(target):
        raise AssertionError("a refused run has published")
    return t.spark.createDataFrame(failed, "year string, department string, rule_id string, violation_count bigint")
