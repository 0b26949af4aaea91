import random
from collections import Counter

import pytest

from landledger.operators import dedup as d
from tests.conftest import day, rows


def test_equal_rows_collapse_and_other_rows_stay(spark):
    df = spark.createDataFrame(
        [("m1", "p1", 1.0)] * 3 + [("m1", "p2", 1.0), ("m1", "p1", 2.0), (None, None, None), (None, None, None)],
        "id string, parcel string, v double",
    )
    kept = d.drop_exact_duplicates(df)
    assert rows(kept) == sorted(
        [("m1", "p1", 1.0), ("m1", "p1", 2.0), ("m1", "p2", 1.0), (None, None, None)],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
    assert rows(d.drop_exact_duplicates(kept)) == rows(kept)


def test_dedup_counts_observed_and_exact(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [("c",)], "k string")
    kept, before, after = d.dedup_with_counts(df, "t")
    assert kept.collect()
    assert (before.get["rows"], after.get["rows"]) == (8, 3)
    assert tuple(d.dedup_counts(df).first()) == (8, 3, 5)
    assert tuple(d.dedup_counts(df.limit(0)).first()) == (0, 0, 0)


def test_repeated_rows_by_fingerprint_agree_with_full_comparison(spark):
    clean = spark.range(1000).selectExpr("id", "CAST(id % 7 AS DOUBLE) AS v", "array(id) AS a")
    assert not d.has_repeated_rows(clean)
    assert d.duplicate_rows(clean).first()["duplicates"] == 0
    dirty = clean.unionByName(clean.filter("id < 3"))
    assert d.has_repeated_rows(dirty)
    assert d.duplicate_rows(dirty).first()["duplicates"] == 3


def test_fingerprint_treats_signed_zero_and_nan_as_equal(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "v double")
    assert d.has_repeated_rows(df)
    assert d.duplicate_rows(df).first()["duplicates"] == 2


def test_duplicates_per_group(spark):
    df = spark.createDataFrame([("x", 1)] * 3 + [("y", 1)], "g string, v int")
    assert rows(d.duplicate_rows(df, ["g"])) == [("x", 2), ("y", 0)]


def test_unique_keys_skip_blank_and_missing_required_parts(spark):
    df = spark.createDataFrame(
        [("4", "RUE A"), ("4", "RUE A"), ("5", ""), ("6", None), (None, "RUE A")], "no string, street string"
    )
    assert rows(d.unique_keys(df, ["no", "street"], ["street"])) == [("4", "RUE A"), (None, "RUE A")]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_number_rows_is_dense_and_in_order(spark, partitions):
    values = list(range(500))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(f"k{v:04d}", v) for v in values], "k string, v int")
    got = sorted((r["id"], r["v"]) for r in d.number_rows(df, ["k"], partitions=partitions).collect())
    assert got == [(i, i) for i in range(500)]


def test_number_rows_of_nothing(spark):
    assert d.number_rows(spark.createDataFrame([], "k string"), ["k"]).collect() == []


RECORDS = "address string, number string, label string, day date"


def test_latest_wins_then_larger_number_then_known_date(spark):
    df = spark.createDataFrame(
        [
            ("a", "1", "D", day("2020-01-01")), ("a", "2", "C", day("2023-01-01")), ("a", "9", "B", None),
            ("b", "1", "A", day("2021-05-05")), ("b", "2", "E", day("2021-05-05")),
            ("c", "1", "F", None), ("c", None, "G", None),
            (None, "7", "A", day("2021-05-05")), (None, "8", "A", day("2021-05-05")),
        ],
        RECORDS,
    )
    got = d.latest_per_key(df, ["address"], ["day", "number"])
    assert [(r[0], r[2]) for r in rows(got)] == [("a", "C"), ("b", "E"), ("c", "F"), (None, "A")]
    kept = d.latest_per_key(df, ["address"], ["day", "number"], keep_null_keys=False)
    assert [r[0] for r in rows(kept)] == ["a", "b", "c"]


def test_full_ties_are_broken_the_same_way_whatever_the_order(spark):
    data = [("a", "1", label, day("2020-01-01")) for label in "CABD"]
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, RECORDS).repartition(3)
        assert d.latest_per_key(df, ["address"], ["day", "number"]).first()["label"] == "D"


def test_hot_key_passes_one_row_per_task_to_the_shuffle(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, id, -1) AS k", "id AS v")
    plan = d.latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_latest_against_brute_force(spark):
    rng = random.Random(11)
    data = [(rng.choice("abcd") if rng.random() > 0.4 else "hot", str(i), "L", rng.choice([None, day("2020-01-01"), day("2021-01-01")])) for i in range(400)]
    expected = {}
    for r in data:
        key = (r[3] is not None, r[3] or day("1900-01-01"), r[1])
        if r[0] not in expected or key > expected[r[0]][0]:
            expected[r[0]] = (key, r)
    got = d.latest_per_key(spark.createDataFrame(data, RECORDS), ["address"], ["day", "number"])
    assert Counter(tuple(r) for r in got.collect()) == Counter(v[1] for v in expected.values())
