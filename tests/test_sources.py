import gzip
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.errors import PythonException

from landledger import sinks, sources
from landledger.operators import snapshot
from landledger.session import object_store_conf, shuffle_partitions_for
from landledger.sources.files import jdbc_read_options
from tests.conftest import rows


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return out.getvalue()


def test_gzip_csv_keeps_zeros_and_reads_blank_as_null(spark, tmp_path):
    text = 'code,street\n01001,"RUE A, B"\n,""\n'
    path = put(tmp_path / "a.csv.gz", gzip.compress(text.encode()))
    assert rows(sources.scan_csv(spark, path, ["code", "street"])) == [("01001", "RUE A, B"), (None, None)]


def test_partition_columns_stay_text_and_prune(spark, tmp_path):
    for year, dept in (("2023", "01"), ("2024", "01"), ("2024", "75")):
        put(tmp_path / f"s/publication=p/year={year}/department={dept}/{dept}.csv", f"v\n{year}{dept}\n")
    df = sources.scan_csv(spark, f"{tmp_path}/s", ["v"], partitions=["publication", "year", "department"])
    assert rows(df.filter("department = '01' AND year = '2024'")) == [("202401", "p", "2024", "01")]
    plan = df.filter("department = '01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(department" in plan
    one = sources.scan_csv(
        spark, f"{tmp_path}/s/publication=p/year=2024/department=01/01.csv", ["v"],
        partitions=["year", "department"], base_path=f"{tmp_path}/s/publication=p",
    )
    assert rows(one) == [("202401", "2024", "01")]


def test_paths():
    keys = {"publication": "2026-04", "year": 2024, "department": "75"}
    assert sources.object_path("s3a://raw/", "sales", keys, "75.csv.gz") == (
        "s3a://raw/sales/publication=2026-04/year=2024/department=75/75.csv.gz"
    )
    assert sources.object_path("", "sales", {}) == "sales"
    assert sources.local_file("landing", ["2026-04", 2024], "75.csv.gz") == "landing/2026-04/2024/75.csv.gz"


def test_json_lines_with_a_bad_number(spark, tmp_path):
    path = put(tmp_path / "a.jsonl", '{"id": "1", "v": 2.5, "extra": 1}\n{"id": "2", "v": "x"}\n{"id": "3"}\n')
    assert rows(sources.scan_jsonl(spark, path, "id string, v double")) == [("1", 2.5), ("2", None), ("3", None)]


def test_zip_member_by_header_name(spark, tmp_path):
    text = 'A;CODE;V\n1;01001;2,5\n2;"7;5";s\n3;;""\n'
    put(tmp_path / "z/a.zip", zipped({"other.csv": "no", "t.csv": text}))
    put(tmp_path / "z/b.zip", zipped({"t.csv": "CODE;V;A\n92012;9;x\n"}))
    df = sources.scan_zip_csv(spark, f"{tmp_path}/z", "t.csv", ["CODE", "V"])
    assert rows(df) == [("01001", "2,5"), ("7;5", "s"), ("92012", "9"), (None, None)]


def test_zip_member_larger_than_one_block(spark, tmp_path):
    lines = [f"{i:07d};{'x' * 50}" for i in range(60_000)]
    put(tmp_path / "a.zip", zipped({"t.csv": "\n".join(["K;V", *lines])}))
    df = sources.scan_zip_csv(spark, f"{tmp_path}/a.zip", "t.csv", ["K", "V"])
    assert (df.count(), df.select("K").distinct().count()) == (60_000, 60_000)


def test_zip_without_the_member_or_column_fails(spark, tmp_path):
    put(tmp_path / "a.zip", zipped({"t.csv": "A\n1\n"}))
    for member, column in (("u.csv", "A"), ("t.csv", "B")):
        with pytest.raises(PythonException):
            sources.scan_zip_csv(spark, f"{tmp_path}/a.zip", member, [column]).collect()


def test_audit_of_a_directory(spark, tmp_path):
    good_zip = zipped({"t.csv": "A\n1\n" * 2000})
    spoiled = bytearray(good_zip)
    spoiled[len(spoiled) // 3] ^= 0xFF
    packed = gzip.compress(json.dumps(list(range(50_000))).encode())
    files = {
        "ok.csv.gz": (packed, ""),
        "two.csv.gz": (packed + packed, ""),
        "cut.csv.gz": (packed[: len(packed) // 2], "not a valid gzip archive"),
        "text.csv.gz": (b"not gzip", "not a valid gzip archive"),
        "empty.csv.gz": (b"", "empty file"),
        "ok.zip": (good_zip, ""),
        "spoiled.zip": (bytes(spoiled), "not a valid zip archive"),
        "text.zip": (b"not zip", "not a valid zip archive"),
        "empty.zip": (b"", "empty file"),
        "ok.json": ('{"nom": "Île"}'.encode(), ""),
        "cut.json": (b'{"nom": ', "not valid JSON"),
        "latin.json": (b'{"nom": "\xcele"}', "not valid JSON"),
        "empty.json": (b"", "empty file"),
        "sub/any.csv": (b"x", ""),
        "sub/empty.csv": (b"", "empty file"),
    }
    for name, (content, _) in files.items():
        put(tmp_path / "raw" / name, content)
    got = {r["path"].split("/raw/")[1]: r for r in sources.audit_files(spark, f"{tmp_path}/raw").collect()}
    assert {n: r["reason"] for n, r in got.items()} == {n: reason for n, (_, reason) in files.items()}
    for name, (content, reason) in files.items():
        assert got[name]["is_valid"] == (reason == "")
        assert got[name]["size"] == len(content)
        assert got[name]["sha256"] == hashlib.sha256(content).hexdigest()
    assert sources.audit_files(spark, f"{tmp_path}/raw", "*.zip").count() == 4


def test_zip_records_that_end_early_or_late(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("m.csv", '\ufeffa;b;c\r\n1;2;3\r\n4\r\n\r\n"x;\n""y";;z;more\r\n')
    archives = spark.createDataFrame([(out.getvalue(),)], "content binary")
    assert rows(sources.read_zip_members(archives, "m.csv", ["c", "a"])) == rows(
        spark.createDataFrame([("3", "1"), (None, "4"), ("z", 'x;\n"y')], "c string, a string")
    )


def test_refused_files_are_not_loaded(spark):
    audit = spark.createDataFrame([("a", "1", True, ""), ("b", "2", False, "empty file"), ("c", "3", True, "")], "path string, sha256 string, is_valid boolean, reason string")
    stored = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    diff = snapshot.audited_diff(audit, stored)
    assert {r["path"]: (r["status"], r["reason"]) for r in diff.collect()} == {"a": ("skipped", ""), "b": ("refused", "empty file"), "c": ("uploaded", "")}
    assert [r["path"] for r in snapshot.to_load(diff).collect()] == ["c"]


def test_diff_of_snapshots(spark):
    incoming = spark.createDataFrame([("new", "a"), ("same", "b"), ("other", "c"), ("unsigned", "d")], "key string, sha256 string")
    stored = spark.createDataFrame([("same", "b"), ("other", "x"), ("gone", "y"), ("unsigned", None)], "key string, sha256 string")
    diff = snapshot.diff_snapshots(incoming, stored, ["key"])
    assert {r["key"]: (r["status"], r["stored_checksum"]) for r in diff.collect()} == {
        "new": ("uploaded", None), "same": ("skipped", "b"), "other": ("changed", "x"), "unsigned": ("uploaded", None),
    }
    assert {r["key"] for r in snapshot.to_load(diff).collect()} == {"new", "other", "unsigned"}


def test_replace_partitions_twice_and_leave_the_rest(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = "v int, year string, department string"
    first = spark.createDataFrame([(1, "2023", "75"), (2, "2024", "75"), (3, "2024", "92")], schema)
    sinks.replace_partitions(first, path, ["year", "department"])
    again = spark.createDataFrame([(9, "2024", "75")], schema)
    for _ in range(2):
        sinks.replace_partitions(again, path, ["year", "department"])
        assert rows(spark.read.schema(schema).parquet(path)) == [(1, "2023", "75"), (3, "2024", "92"), (9, "2024", "75")]


def test_owned_partitions_without_rows_are_removed(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = "v int, year string, department string"
    first = spark.createDataFrame([(1, "2023", "01"), (2, "2024", "01"), (3, "2024", "92")], schema)
    sinks.replace_partitions(first, path, ["year", "department"])
    again = spark.createDataFrame([(9, "2024", "92")], schema)
    for _ in range(2):
        sinks.replace_partitions(again, path, ["year", "department"], owned=[("2024", "01"), ("2024", "92"), ("2031", "01")])
        assert rows(sources.scan_table(spark, path, ["year", "department"])) == [(1, "2023", "01"), (9, "2024", "92")]


def test_overwrite_and_scan_table(spark, tmp_path):
    sinks.overwrite(spark.range(5), f"{tmp_path}/t")
    sinks.overwrite(spark.range(2), f"{tmp_path}/t")
    assert sources.scan_table(spark, f"{tmp_path}/t").count() == 2
    spark.range(3).createOrReplaceTempView("named_table")
    assert sources.scan_table(spark, "named_table").count() == 3


def test_jdbc_options_and_session_settings():
    plain = jdbc_read_options("jdbc:x", "t", "u", "p")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p"}
    split = jdbc_read_options("jdbc:x", "t", "u", "p", "d", "id", (0, 100), 8)
    assert (split["partitionColumn"], split["upperBound"], split["numPartitions"]) == ("id", "100", "8")
    with pytest.raises(ValueError, match="bounds"):
        jdbc_read_options("jdbc:x", "t", "u", "p", partition_column="id")
    conf = object_store_conf("http://host:1", "a", "s", ("g:a:1",))
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false" and conf["spark.jars.packages"] == "g:a:1"
    assert shuffle_partitions_for(100 << 40) == 819_200 and shuffle_partitions_for(1) == 200
