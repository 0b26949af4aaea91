"""Every registered query against its oracle, on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from landledger import sinks
from landledger.plans import silver
from landledger.session import CLEANUP, checkpoint_dir
from landledger.showcase import ORACLES, QUERIES, runs
from landledger.showcase.registry import Tables
from tools.check_oracles import TABLES, plain

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_names_agree():
    assert set(ORACLES) == set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, duck, name):
    got_types, got = plain(QUERIES[name](spark, FOLDER).toArrow())
    want_types, want = plain(duck.sql(ORACLES[name]).to_arrow_table())
    assert got_types == want_types
    assert got == want


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_raw_partitions_are_written_by_all_tasks(spark, tmp_path):
    lines = runs.clean_sales(Tables(spark, FOLDER)).repartition(3)
    runs.rewrite_sales(lines, str(tmp_path), 1997, "13")
    parts = list(tmp_path.rglob("part-*.csv.gz"))
    assert len(parts) == 3
    layout = silver.RawLayout(str(tmp_path), runs.PUBLICATION, runs.EXTRACTED, runs.EXTRACTED)
    asked = spark.createDataFrame([("1997", "13")], "year string, department string")
    written = silver.read_sales(spark, layout, asked=asked)
    assert written.count() == lines.filter("year = 1997 AND department = '13'").count() > 0


def test_asked_partitions_prune_folders_at_run_time(spark, tmp_path):
    lines = runs.clean_sales(Tables(spark, FOLDER))
    runs.write_sales(lines, str(tmp_path))
    wanted = lines.select("year", "department").distinct().filter("year % 2 = 0 AND department <> '75'")
    wanted.write.parquet(f"{tmp_path}/wanted")
    asked = spark.read.parquet(f"{tmp_path}/wanted")
    layout = silver.RawLayout(str(tmp_path), runs.PUBLICATION, runs.EXTRACTED, runs.EXTRACTED)
    read = silver.read_sales(spark, layout, asked=asked)
    assert read.count() == lines.filter("year % 2 = 0 AND department <> '75'").count() > 0
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def left_by(spark, name):
    """Labels of the tables that a query leaves in the scratch folder."""
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    QUERIES[name](spark, FOLDER)
    return sorted(n.partition("-")[0] for n in set(os.listdir(folder)) - before)


def test_runs_leave_what_they_publish(spark):
    assert left_by(spark, "gold_run") == ["gold", "gold", "silver"]


def test_sales_are_staged_before_they_are_dealt_to_partitions(spark, monkeypatch):
    """Shuffle files of the lookups are gone by then."""
    seen = []

    def replace(df, *rest):
        seen.append((df._jdf.queryExecution().executedPlan().toString(), spark.conf.get(CLEANUP, None)))
        return replace_partitions(df, *rest)

    replace_partitions = sinks.replace_partitions
    monkeypatch.setattr(sinks, "replace_partitions", replace)
    assert left_by(spark, "silver_partitions") == ["published"]
    [(plan, cleanup)] = seen
    assert "Exchange" not in plan and "Join" not in plan and cleanup == "true"
