"""Listing by tasks, byte ranges, archive members and streamed checks."""

import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landledger import sources
from landledger.sources import audit, ranges
from landledger.sources.json_text import JsonSyntax
from tests.conftest import rows
from tests.test_sources import put, zipped


def names(df, root):
    return sorted(r["path"].split(f"{root}/")[1] for r in df.collect())


def test_listing_finds_every_file_once(spark, tmp_path):
    for name in ("a.csv", "empty.csv", "x/b.csv", "x/y/c.json", "x/y/d e.csv", "z/é[1].csv", "_temporary/no.csv", "x/.hidden", "x/_SUCCESS"):
        put(tmp_path / name, b"" if "empty" in name else b"12345")
    root = str(tmp_path)
    assert names(sources.list_files(spark, root), root) == ["a.csv", "empty.csv", "x/b.csv", "x/y/c.json", "x/y/d e.csv", "z/é[1].csv"]
    assert names(sources.list_files(spark, root, "*.json"), root) == ["x/y/c.json"]
    assert names(sources.list_files(spark, f"{root}/*"), root) == names(sources.list_files(spark, root), root)
    assert names(sources.list_files(spark, f"{root}/x/*.csv"), root) == ["x/b.csv"]
    assert names(sources.list_files(spark, [f"{root}/a.csv", f"{root}/x/y"]), root) == ["a.csv", "x/y/c.json", "x/y/d e.csv"]
    assert {r["size"] for r in sources.list_files(spark, root).collect()} == {0, 5}
    # one task per folder below the root and one for its own files
    assert sources.list_files(spark, root).rdd.getNumPartitions() == 3
    with pytest.raises(Exception, match="FileNotFound|nowhere"):
        sources.list_files(spark, f"{root}/nowhere").collect()


def test_blocks_of_a_file_run_on_several_tasks(spark, tmp_path):
    content = random.Random(1).randbytes(100_003)
    put(tmp_path / "a.bin", content)
    put(tmp_path / "empty.bin", b"")
    files = sources.list_files(spark, str(tmp_path))
    for size in (1 << 20, 100_003, 4096, 999):
        blocks = sources.read_blocks(files, size).collect()
        parts = {name: b"".join(bytes(r["content"]) for r in sorted(blocks, key=lambda r: r["block"]) if r["path"].endswith(name)) for name in ("/a.bin", "/empty.bin")}
        assert parts == {"/a.bin": content, "/empty.bin": b""}
        assert max(len(r["content"]) for r in blocks) <= size
    from pyspark.sql import functions as F

    tasks = sources.read_blocks(files, 4096).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1
    sums = sources.block_checksums(files, 4096).filter("length > 0").orderBy("block").collect()
    cut = [content[k : k + 4096] for k in range(0, len(content), 4096)]
    assert [(r["length"], r["lines"], r["sha256"]) for r in sums] == [(len(c), c.count(b"\n"), hashlib.sha256(c).hexdigest()) for c in cut]


def test_members_of_one_archive_run_on_several_tasks(spark, tmp_path):
    members = {f"m{k}.csv": "K;V\n" + "".join(f"{k};{v}\n" for v in range(500 + k)) for k in range(20)}
    put(tmp_path / "a.zip", zipped({**members, "readme.txt": "no"}))
    listed = sources.list_members(sources.list_files(spark, str(tmp_path)), "*.csv")
    assert {(r["member"], r["size"]) for r in listed.collect()} == {(n, len(t)) for n, t in members.items()}
    read = sources.read_members(listed, ["K", "V"])
    assert read.rdd.getNumPartitions() > 1
    assert rows(read.groupBy("K").count()) == rows(spark.createDataFrame([(str(k), 500 + k) for k in range(20)], "K string, count bigint"))
    assert sources.scan_zip_csv(spark, str(tmp_path), "m*.csv", ["V"]).count() == sum(500 + k for k in range(20))


def test_audit_plans_without_names_on_the_driver(spark, tmp_path):
    put(tmp_path / "a.json", json.dumps({"x": ["é" * 10, {"y": [1, -2.5e3, None, True]}] * 40_000}).encode())
    put(tmp_path / "cut.json", b'{"a": "' + b"x" * 3_000_000)
    audited = sources.audit_files(spark, str(tmp_path))
    got = {r["path"].rsplit("/", 1)[1]: (r["is_valid"], r["size"] > audit.BLOCK_BYTES) for r in audited.collect()}
    assert got == {"a.json": (True, True), "cut.json": (False, True)}
    plan = audited._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_listing" in plan and "LocalRelation" not in plan


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats() | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=4), inner, max_size=4),
    max_leaves=12,
)


def accepted(raw, size):
    document = JsonSyntax()
    return all(document.feed(raw[k : k + size]) for k in range(0, len(raw), size)) and document.feed(b"", last=True)


def parses(raw):
    try:
        json.loads(raw.decode("utf-8"))
    except ValueError:
        return False
    return True


@settings(max_examples=300, deadline=None)
@given(VALUES, st.booleans(), st.integers(1, 9), st.integers(0, 10**6), st.sampled_from(list(b'"\\{}[],:x1 \n\x01\xff')))
def test_json_syntax_agrees_with_the_parser(value, ascii_only, size, place, byte):
    raw = json.dumps(value, ensure_ascii=ascii_only).encode("utf-8", "replace")
    assert accepted(raw, size)
    spoiled = bytearray(raw)
    spoiled[place % len(raw)] = byte
    for changed in (bytes(spoiled), raw[: place % len(raw)], raw + bytes([byte])):
        assert accepted(changed, size) == parses(changed)


@pytest.mark.parametrize("raw", [b"", b" ", b"{}x", b"[1,]", b'{"a":1,}', b'{"a"}', b"01", b"-", b"1.", b"+1", b'"\\u12"', b'"\\u12', b"\xef\xbb\xbf{}", b"nul", b"[}", b"-Infinity", b"1e5", b'"\\', b"]", b","])
def test_json_syntax_of_odd_texts(raw):
    for size in (1, 2, 100):
        assert accepted(raw, size) == parses(raw)


def test_wildcards_do_not_pass_slashes():
    root, pattern = ranges.split_glob("s3a://bucket/raw/*/x?.csv/")
    assert root == "s3a://bucket/raw" and ranges.split_glob("/a/b/") == ("/a/b", None)
    assert pattern.match("d/x1.csv") and pattern.match("d/x1.csv/part-0") and not pattern.match("d/e/x1.csv") and not pattern.match("d/x1.csvs")
