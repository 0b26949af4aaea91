"""Rejected values, frequent keys, chains, co-located lookups and their plans."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from landledger.operators import chains, evaluation, frequent, lookup, rejects
from landledger.showcase import ledger
from landledger.showcase.registry import Tables
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rejected_values_by_row_and_by_column(spark):
    raw = spark.createDataFrame(
        [("1", "2,5", "2024-02-30", "a"), (" ", "", None, "b"), ("x1", "1.5", "2024-02-29", None), ("x1", "s", "", "")],
        "i string, `d.c` string, day string, other string",
    )
    fields = rejects.parsers(ints=["i"], commas=["d.c"], dates=["day"])
    assert rows(rejects.rejected_values(raw, fields)) == [("d.c", "s", 1), ("day", "2024-02-30", 1), ("i", "x1", 2)]
    by_row = [[tuple(x) for x in r["rejected"]] for r in rejects.with_rejects(raw, fields).collect()]
    assert sorted(map(len, by_row)) == [0, 1, 1, 2]
    assert rejects.rejected_values(raw, {}).count() == 0 == rejects.rejected_values(raw.limit(0), fields).count()


def test_rejected_json_lines(spark):
    lines = ['{"id": 1, "v": 2}', '{"id": "x", "v": "2.5"}', '{"id": null}', "[1]", '{"id": 1', "", None, '{"id": 1.5, "v": {"a": 1}}', "3"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    schema = spark.createDataFrame([], "id bigint, v double").schema
    got = {(r["column"], r["value"]): r["rows"] for r in rejects.rejected_json(df, schema).collect()}
    assert got[("id", '"x"')] == 1 and got[("v", '{"a":1}')] == 1
    assert {v for c, v in got if c == "_corrupt_record"} == {"[1]", '{"id": 1', "3"}
    assert ("v", '"2.5"') not in got  # a text that is a number fits


@pytest.mark.parametrize("share", [0.5, 0.05, 0.01])
def test_frequent_keys_are_exact(spark, share):
    rng = random.Random(2)
    keys = [(rng.choice(["hot", "warm", None]) if rng.random() < 0.5 else f"k{int(rng.paretovariate(0.7))}", rng.randrange(3)) for _ in range(20_000)]
    df = spark.createDataFrame(keys, "a string, b int").repartition(5)
    for null_safe in (False, True):
        usable = [k for k in keys if null_safe or k[0] is not None]
        want = {k: n for k, n in Counter(usable).items() if n >= share * len(usable)}
        got = frequent.frequent_keys(df, ["a", "b"], share, null_safe=null_safe)
        assert {(r["a"], r["b"]): r["rows"] for r in got.collect()} == want
    # only rows of the named hashes reach the aggregate
    assert "LeftSemi" in plan(got)


def test_frequent_keys_of_nothing(spark):
    assert frequent.frequent_keys(spark.range(0), ["id"], 0.1).count() == 0
    with pytest.raises(ValueError, match="share"):
        frequent.frequent_keys(spark.range(1), ["id"], 0)


def test_chains_end_and_circles_are_told(spark):
    mapping = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "z"), ("z", "y"), ("s", "s"), ("into", "s"), (None, "q"), ("n", None), ("a", "b")]
    got = chains.final_parents(spark.createDataFrame(mapping, "old string, new string"), "old", "new")
    assert {r["old"]: (r["new"], r["steps"], r["cyclic"]) for r in got.collect()} == {
        "a": ("d", 3, False), "b": ("d", 2, False), "c": ("d", 1, False),
        "x": (None, 3, True), "y": (None, 2, True), "z": (None, 2, True), "s": (None, 1, True), "into": (None, 2, True),
    }
    long = spark.createDataFrame([(k, k + 1) for k in range(150)], "old int, new int")
    assert chains.final_parents(long, "old", "new").filter("new = 150 AND steps = 150 - old").count() == 150
    with pytest.raises(Exception, match="RECURSION"):
        chains.final_parents(long, "old", "new", most_steps=20)


def test_colocated_lookup_shuffles_nothing(spark, no_broadcast):
    orders, customers = ledger.bucketed_sides(Tables(spark, FOLDER))
    joined = lookup.colocated_lookup(orders, customers, ["custkey"])
    assert "Exchange" not in plan(joined)
    assert joined.count() == orders.count()
    assert rows(joined) == rows(lookup.lookup_join(orders, customers, ["custkey"]))
    with pytest.raises(ValueError, match="both sides"):
        lookup.colocated_lookup(orders, customers.withColumnRenamed("c_name", "o_totalprice"), ["custkey"])


def test_key_differences_in_both_directions(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None)], "k int, s string")
    right = spark.createDataFrame([(2, "b"), (4, "d"), (None, "x")], "k int, s string")
    assert rows(lookup.key_differences(left, right, ["k", "s"])) == [(1, "a", 2, 0, "left"), (4, "d", 0, 1, "right")]


def test_as_of_is_a_merge(spark, no_broadcast):
    rng = random.Random(5)
    start = dt.date(2020, 1, 28)

    def day():
        return start + dt.timedelta(rng.randrange(400))

    left = [(n, rng.choice("abc") if n % 9 else None, day() if n % 7 else None) for n in range(300)]
    right = [(n, rng.choice("abcd") if n % 11 else None, day() if n % 5 else None) for n in range(200)]
    found = evaluation.as_of(
        spark.createDataFrame(left, "id int, k string, d date"), spark.createDataFrame(right, "value int, rk string, rd date"),
        "k", "d", "rk", "rd", ["value"], ["value"],
    )
    want = []
    for n, k, d in left:
        known = [(rd, v) for v, rk, rd in right if k is not None and rk == k and d is not None and rd is not None and rd <= d]
        want.append((n, k, d, max(known)[1] if known else None))
    assert rows(found) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
    assert "NestedLoop" not in plan(found) and "<=" not in plan(found).split("SortMergeJoin")[1].split("\n")[0]


def test_as_of_of_timestamps_and_numbers(spark):
    left = spark.createDataFrame([(1, 5), (2, 1), (3, 9)], "id int, d int").withColumn("k", F.lit("a"))
    right = spark.createDataFrame([("x", 2), ("y", 5), ("z", 7)], "value string, rd int").withColumn("rk", F.lit("a"))
    got = evaluation.as_of(left, right, "k", "d", "rk", "rd", ["value"])
    assert {r["id"]: r["value"] for r in got.collect()} == {1: "y", 2: None, 3: "z"}
