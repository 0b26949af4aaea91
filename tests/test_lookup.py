import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from landledger import functions as lf
from landledger.operators import lookup as lk
from tests.conftest import rows

KEY = ["no", "street"]


def sides(spark):
    left = spark.createDataFrame(
        [(1, 4, "A", 10), (2, 4, "A", 20), (3, 5, "A", 30), (4, None, "A", 40), (5, 4, None, 50)],
        "id int, no int, street string, price int",
    )
    right = spark.createDataFrame([(4, "A", "ok"), (None, "A", "lost")], "no int, street string, status string")
    return left, right


def test_shared_keys_come_first_and_rows_are_kept(spark):
    left, right = sides(spark)
    out = lk.lookup_join(left, right, KEY)
    assert out.columns == ["no", "street", "id", "price", "status"]
    assert {r["id"]: r["status"] for r in out.collect()} == {1: "ok", 2: "ok", 3: None, 4: None, 5: None}


def test_null_safe_keys_match_each_other(spark):
    left, right = sides(spark)
    out = lk.lookup_join(left, right, KEY, null_safe=True)
    assert {r["id"]: r["status"] for r in out.collect()} == {1: "ok", 2: "ok", 3: None, 4: "lost", 5: None}


def test_renamed_keys_are_dropped(spark):
    left, right = sides(spark)
    other = right.withColumnRenamed("street", "voie").drop("no").filter("status = 'ok'")
    out = lk.lookup_join(left, other, left_on=["street"], right_on=["voie"])
    assert out.columns == ["id", "no", "street", "price", "status"]
    assert out.count() == left.count()


def test_derived_key(spark):
    left = spark.createDataFrame([("75117",), ("75101",), ("93059",), ("01001",), (None,)], "code string")
    right = spark.createDataFrame([("75056", "Paris"), ("93066", "Saint-Denis")], "insee string, nom string")
    parent = lf.map_key("code", [("751", "75056")], {"93059": "93066"})
    out = lk.lookup_join(left, right, left_on=[parent], right_on=["insee"])
    assert rows(out) == [("01001", None), ("75101", "Paris"), ("75117", "Paris"), ("93059", "Saint-Denis"), (None, None)]


def test_a_repeated_lookup_key_fans_out_and_is_measured(spark):
    left, right = sides(spark)
    twice = right.unionByName(right)
    assert lk.lookup_join(left, twice, KEY).count() == left.count() + 2
    size = lk.measure_side(twice, KEY)
    assert (size.rows, size.surplus) == (4, 1)  # NULL keys cannot fan out
    assert size.bytes > 0
    empty = lk.measure_side(right.limit(0), KEY)
    assert tuple(empty) == (0, 0, 0)


def test_argument_errors(spark):
    left, right = sides(spark)
    with pytest.raises(ValueError, match="on"):
        lk.lookup_join(left, right)
    with pytest.raises(ValueError, match="price"):
        lk.lookup_join(left, right.withColumnRenamed("status", "price"), KEY)


@pytest.mark.parametrize("options", [{}, {"spread_nulls": False}, {"hot_share": 0.2, "rows_per_salt": 40}, {"hot_share": 0.9}])
def test_every_strategy_gives_the_same_rows(spark, options):
    """A third of the rows has one key, a third has none."""
    rng = random.Random(5)
    keys = ["hot" if u < 1 / 3 else None if u < 2 / 3 else f"k{int(u * 90)}" for u in (rng.random() for _ in range(600))]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string")
    names = ["hot", *[f"k{i}" for i in range(60, 90, 2)]]
    right = spark.createDataFrame([(n, n.upper()) for n in names], "key string, label string")
    expected = Counter((i, k, k.upper() if k in names else None) for i, k in enumerate(keys))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lk.lookup_join(left, right, left_on=["k"], right_on=["key"], **options)
        assert Counter(tuple(r) for r in out.collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_spread_by_the_shuffle(spark):
    left = spark.range(4000).selectExpr("id", "IF(id % 3 = 0, NULL, CAST(id AS STRING)) AS k")
    right = spark.range(50).selectExpr("CAST(id AS STRING) AS key", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lk.lookup_join(left, right, left_on=["k"], right_on=["key"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [_lk0" in plan and "_ls" not in plan
        # a right side that is grouped by its key is not shuffled again
        grouped = right.groupBy("key").agg(F.max("v").alias("v"))
        plan = lk.lookup_join(left, grouped, left_on=["k"], right_on=["key"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salting_evens_out_the_tasks(spark):
    """A key with a third of the rows, and another third without a key."""
    left = spark.range(30_000).selectExpr("id", "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN CAST(id AS STRING) END AS k")
    right = spark.range(0, 30_000, 3).selectExpr("CAST(id + 1 AS STRING) AS key", "id AS v").union(
        spark.sql("SELECT 'hot', -1L")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        def largest(**options):
            out = lk.lookup_join(left, right, left_on=["k"], right_on=["key"], **options)
            return out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(spread_nulls=False) > 10_000
        assert largest(hot_share=0.1, rows_per_salt=200) < 4_000
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_keys_are_those_above_the_share(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 30 + [("c",)] * 10 + [(None,)] * 100, "k string")
    assert rows(lk.hot_keys(df, ["k"], 0.3)) == [("a",), ("b",)]
    assert lk.hot_keys(df, ["k"], 0.7).count() == 0


def test_broadcast_only_within_the_measured_bounds(spark):
    df = spark.range(10)
    def hinted(size):
        return "broadcast" in lk.broadcast_within(df, size, max_bytes=100, max_rows=10)._jdf.queryExecution().analyzed().toString()
    assert hinted(lk.SideSize(10, 100, 0))
    assert not hinted(lk.SideSize(11, 100, 0))
    assert not hinted(lk.SideSize(10, 101, 0))


def test_match_counts_observed_and_exact(spark):
    left, right = sides(spark)
    joined, seen = lk.observe_matches(lk.lookup_join(left, right, KEY), "status", "m")
    joined.collect()
    assert seen.get == {"rows": 5, "matched": 2, "unmatched": 3}
    assert tuple(lk.match_counts(joined, "status").first()) == (5, 2, 3)


def test_coverage_lowest_first(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("x", None), ("y", 1), ("z", None)], "g string, m int")
    got = [tuple(r) for r in lk.coverage_by_group(df, ["g"], "m").collect()]
    assert got == [("z", 1, 0, 0.0), ("x", 3, 1, 33.3), ("y", 1, 1, 100.0)]


def test_missing_keys_both_ways(spark):
    a = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "k string")
    b = spark.createDataFrame([("2",), ("2",), ("3",)], "k string")
    assert rows(lk.missing_keys(a, b, ["k"])) == [("1",)]
    assert rows(lk.missing_keys(b, a, ["k"])) == [("3",)]


def test_remap_keys(spark):
    df = spark.createDataFrame([("old",), ("same",), (None,)], "k string")
    mapping = spark.createDataFrame([("old", "new")], "a string, b string")
    assert rows(lk.remap_keys(df, "k", mapping, "a", "b", "parent")) == [("old", "new"), ("same", "same"), (None, None)]


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "date", "double"])
def test_null_keys_match_nothing_whatever_their_type(spark, kind):
    values = {"date": "DATE '2024-01-01' + CAST(id AS INT)"}.get(kind, f"CAST(id AS {kind})")
    left = spark.range(60).selectExpr("id", f"IF(id % 3 = 0, NULL, {values}) AS k", "IF(id % 2 = 0, NULL, id) AS j")
    right = spark.range(60).selectExpr(f"{values} AS k", "id AS j", "id AS v")
    out = {r["id"]: r["v"] for r in lk.lookup_join(left, right, ["k", "j"]).collect()}
    assert out == {i: i if i % 3 and i % 2 else None for i in range(60)}


def test_hot_null_key_of_a_null_safe_join(spark):
    left = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(100)], "id int, k string")
    right = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    out = lk.lookup_join(left, right, ["k"], null_safe=True, hot_share=0.3, rows_per_salt=10)
    assert Counter(r["v"] for r in out.collect()) == {1: 50, 2: 50}
    with pytest.raises(ValueError, match="share"):
        lk.hot_keys(left, ["k"], 0)


@pytest.mark.parametrize("hot", [False, True])
def test_distinct_left_rows_are_shuffled_once(spark, hot):
    left = spark.createDataFrame(
        [(1, "a", 0.0), (1, "a", -0.0), (1, "b", 1.0), (None, "c", None), (None, "c", None), (None, "d", 2.0), (2, "e", 5.0)],
        "k int, t string, v double",
    ).repartition(3)
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, r string")
    keys = spark.createDataFrame([(1, 3)], "k int, n long") if hot else None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = lk.lookup_join(left, right, ["k"], hot=keys, rows_per_salt=1, distinct=True)
        got = rows(out)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(
        [(1, "a", 0.0, "x"), (1, "a", 0.0, "y"), (1, "b", 1.0, "x"), (1, "b", 1.0, "y"), (2, "e", 5.0, None),
         (None, "c", None, None), (None, "d", 2.0, None)],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
    final = plan.split("Initial Plan")[0]
    # of the left side, of the right side, and this test's own
    assert hot or final.count("Exchange hashpartitioning") == 2
