import random
import statistics

import pytest

from landledger.operators import evaluation as e
from tests.conftest import day, rows


def test_population_and_split(spark):
    df = spark.createDataFrame([("Vente", "A"), ("Vente", None), ("Don", "A"), (None, "A")], "nature string, kind string")
    assert rows(e.eligible(df, {"nature": ["Vente"], "kind": ["A", "B"]})) == [("Vente", "A")]
    days = spark.createDataFrame([(day("2024-09-30"),), (day("2024-10-01"),), (day("2024-12-31"),), (day("2025-01-01"),), (None,)], "d date")
    got = e.chronological_split(days, "d", day("2024-10-01"), day("2024-12-31"))
    assert [r["part"] for r in got.collect()] == ["train", "test", "test", None, None]


def test_as_of_takes_the_newest_before(spark):
    rng = random.Random(3)
    dates = [day(f"2024-01-{d:02d}") for d in range(1, 29)]
    right = [(rng.choice("ab"), rng.choice([*dates, None]), i, f"L{i}") for i in range(60)] + [(None, dates[0], 99, "n")]
    left = [(i, rng.choice(["a", "b", "c", None]), rng.choice([*dates, None])) for i in range(200)]
    left += left[:3]
    out = e.as_of(
        spark.createDataFrame(left, "id int, k string, d date"), spark.createDataFrame(right, "rk string, rd date, n int, label string"),
        "k", "d", "rk", "rd", ["n", "label"], ["n"],
    )
    def expected(k, d):
        known = [r for r in right if d and k and r[0] == k and r[1] and r[1] <= d]
        return max(known, key=lambda r: (r[1], r[2]))[2:] if known else (None, None)
    assert rows(out) == sorted([(i, k, d, *expected(k, d)) for i, k, d in left], key=lambda t: tuple((v is None, str(v)) for v in t))


def test_baseline_and_its_errors(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", 5.0), (None, 4.0)], "area string, price double")
    test = spark.createDataFrame([(1, "a", 3.0), (2, "c", 3.0), (3, None, 0.0), (4, "b", None)], "id int, area string, price double")
    got = e.naive_baseline(train, test, "area", "price")
    assert {r["id"]: (r["predicted"], r["predicted_from_area"]) for r in got.collect()} == {
        1: (2.0, True), 2: (4.0, False), 3: (4.0, False), 4: (5.0, True),
    }
    r = e.error_measures(got, "price", "predicted").first()
    errors = [-1.0, 1.0, 4.0]
    assert r["n"] == 3 and r["mae"] == pytest.approx(2.0)
    assert r["rmse"] == pytest.approx(statistics.fmean(x * x for x in errors) ** 0.5)
    assert r["mape"] == pytest.approx(100 / 3) and r["r2"] == pytest.approx(1 - 18 / 6)
    flat = spark.createDataFrame([(1.0, 2.0)], "y double, p double")
    assert e.error_measures(flat, "y", "p").first()["r2"] is None
