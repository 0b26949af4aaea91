"""Publication in one switch."""

import os

import pytest
from pyspark.sql import functions as F

from landledger import publication
from landledger.sources import scan_table
from tests.conftest import rows

SALES = "id int, price double, year string, department string"


def table(spark, lines):
    return spark.createDataFrame(lines, SALES)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if not f.endswith(".crc")}


@pytest.fixture
def path(spark, tmp_path):
    target = str(tmp_path / "sales")
    first = [(1, 1.0, "2023", "01"), (2, 2.0, "2023", "92"), (3, 3.0, "2024", "01"), (4, None, "2024", None)]
    assert publication.publish(table(spark, first), target, ["year", "department"]) == 1
    return target


def test_partitions_are_replaced_and_text_stays_text(spark, path):
    again = [(9, 9.0, "2023", "01"), (10, 1.0, "2025", "2A/ é"), (11, 1.0, "2025", "[x]{y}*")]
    assert publication.publish(table(spark, again), path, ["year", "department"], owned=[("2024", "01"), ("2030", "75")]) == 2
    want = sorted([(9, 9.0, "2023", "01"), (2, 2.0, "2023", "92"), (4, None, "2024", None), *again[1:]])
    assert sorted(tuple(r) for r in publication.read_published(spark, path).collect()) == want
    assert sorted(tuple(r) for r in scan_table(spark, path, ["year", "department"]).collect()) == want
    assert publication.read_published(spark, path, version=1).count() == 4
    assert rows(publication.read_published(spark, path, only=[("2023", "92")])) == [(2, 2.0, "2023", "92")]
    assert publication.read_published(spark, path, only=[("1999", "92")]).count() == 0
    assert publication.changed_partitions(path, 1) == [
        ("2023", "01"), ("2024", "01"), ("2025", "2A/ é"), ("2025", "[x]{y}*")
    ]
    assert len(publication.changed_partitions(path, None)) == 5


def test_a_failing_task_leaves_the_table_and_no_files(spark, path):
    before, listed = rows(publication.read_published(spark, path)), files(path)
    # every partition is replaced; one row in the middle of one task fails
    bad = table(spark, [(k, float(k), "2024", f"{k % 7:02d}") for k in range(5000)]).repartition(4, "department")
    bad = bad.sortWithinPartitions("year", "department", "id").withColumn("price", F.when(F.col("id") == 3333, F.raise_error(F.lit("torn"))).otherwise(F.col("price")))
    with pytest.raises(Exception, match="torn"):
        publication.publish(bad, path, ["year", "department"], owned=[("2023", "01")], arranged=True)
    assert publication.versions(path) == [1]
    assert rows(publication.read_published(spark, path)) == before
    assert listed <= files(path)  # files of the failed attempt itself may be left, named by no version


def test_two_publishers_both_take_effect(spark, path, monkeypatch):
    writer = publication.PublicationWriter(path, table(spark, []).schema, ["year", "department"], [["2023", "92"]], {})
    real, calls = publication._create, []

    def late(store, root, version):
        calls.append(version.number)
        if len(calls) == 1:  # another run publishes between reading and creating
            publication.PublicationWriter(path, writer.schema, writer.partitions, [["2023", "01"]], {}).commit([])
        return real(store, root, version)

    monkeypatch.setattr(publication, "_create", late)
    writer.commit([publication.Written([])])
    assert calls == [2, 2, 3] and publication.versions(path) == [1, 2, 3]
    assert sorted(r["id"] for r in publication.read_published(spark, path).collect()) == [3, 4]


def test_abort_removes_the_files_of_finished_tasks(spark, path, tmp_path):
    lone = tmp_path / "sales" / "data" / "part-x.parquet"
    lone.write_bytes(b"x")
    writer = publication.PublicationWriter(path, table(spark, []).schema, ["year", "department"], [], {})
    writer.abort([publication.Written([(["2023", "01"], "data/part-x.parquet", 1)]), None])
    assert not lone.exists() and publication.read_published(spark, path).count() == 4


def test_whole_tables_notes_and_expiry(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publication.versions(path) == [] and publication.read_version(path) is None
    with pytest.raises(ValueError, match="nothing is published"):
        publication.read_published(spark, path)
    for n in range(1, 5):
        assert publication.publish(spark.range(n), path, note={"n": n}) == n
    assert publication.read_published(spark, path).count() == 4 and publication.read_version(path, 2).note == {"n": 2}
    assert publication.expire_versions(path, keep=2) > 0
    assert publication.versions(path) == [3, 4] and publication.read_published(spark, path, 3).count() == 3
    assert publication.publish(spark.range(0), path) == 5 and publication.read_published(spark, path).count() == 0
    with pytest.raises(ValueError, match="no version"):
        publication.read_published(spark, path, 1)
    with pytest.raises(Exception, match="partitioned by"):
        publication.publish(spark.range(3).withColumn("k", F.lit("a")), path, ["k"])
