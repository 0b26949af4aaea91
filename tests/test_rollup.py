import random
import statistics

import pytest
from pyspark.sql import functions as F

from landledger.operators import rollup
from landledger.plans import gold
from landledger.plans import property_model as m
from tests.conftest import day, rows

SALE = {
    "id_mutation": "2024-1",
    "code_commune": "75101",
    "code_departement": "75",
    "nature_mutation": "Vente",
    "date_mutation": day("2024-05-15"),
    "valeur_fonciere": 400000.0,
    "surface_reelle_bati": 40.0,
}
SCHEMA = (
    "id_mutation string, code_commune string, code_departement string, nature_mutation string,"
    " date_mutation date, valeur_fonciere double, surface_reelle_bati double"
)


def sales(spark, *overrides):
    return spark.createDataFrame([tuple({**SALE, **o}.values()) for o in overrides], SCHEMA)


def test_only_ordinary_priced_sales_count(spark):
    df = sales(
        spark,
        {},
        {"id_mutation": "x1", "nature_mutation": "Echange"},
        {"id_mutation": "x2", "surface_reelle_bati": None},
        {"id_mutation": "x3", "surface_reelle_bati": 0.0},
        {"id_mutation": "x4", "valeur_fonciere": None},
        {"id_mutation": "x5", "valeur_fonciere": -1.0},
    )
    out = gold.price_by_commune(df).collect()
    assert [tuple(r) for r in out] == [("75101", "2024-Q2", 1, 10000.0, 10000.0, 400000.0, 400000.0, 40.0)]
    assert out[0].__fields__ == [
        "code_commune", "quarter", "nb_transactions", "median_price_per_sqm", "avg_price_per_sqm",
        "median_valeur_fonciere", "avg_valeur_fonciere", "avg_surface_reelle_bati",
    ]


def test_a_sale_of_many_lots_is_one_transaction(spark):
    lots = [{"valeur_fonciere": 52_000_000.0, "surface_reelle_bati": s} for s in (12.0, 28.0, 90.0)]
    for table in (gold.price_by_commune(sales(spark, *lots)), gold.price_by_department(sales(spark, *lots))):
        row = table.first()
        assert row["nb_transactions"] == 1
        assert row["avg_price_per_sqm"] == pytest.approx(52_000_000 / 130)
        assert row["avg_surface_reelle_bati"] == 130.0


def test_departments_gather_their_communes(spark):
    df = sales(
        spark,
        {"id_mutation": "a", "code_commune": "75101"},
        {"id_mutation": "b", "code_commune": "75102", "valeur_fonciere": 200000.0},
        {"id_mutation": "c", "code_commune": "75103", "valeur_fonciere": 600000.0},
        {"id_mutation": "d", "code_commune": "92012", "code_departement": "92", "date_mutation": day("2024-12-31")},
    )
    got = [tuple(r)[:4] for r in gold.price_by_department(df).orderBy("code_departement").collect()]
    assert got == [("75", "2024-Q2", 3, 10000.0), ("92", "2024-Q4", 1, 10000.0)]
    assert gold.price_by_commune(df).count() == 4


def test_both_tables_from_one_pass_equal_the_single_ones(spark):
    rng = random.Random(2)
    df = sales(
        spark,
        *[
            {
                "id_mutation": f"m{rng.randrange(150)}",
                "code_commune": rng.choice(["75101", "75102", None]),
                "code_departement": rng.choice(["75", "92"]),
                "date_mutation": day(f"2024-{rng.randrange(1, 13):02d}-10"),
                "surface_reelle_bati": float(rng.randrange(1, 100)),
            }
            for _ in range(400)
        ],
    )
    tables = gold.build_gold(df)
    assert rows(tables["code_commune"]) == rows(gold.price_by_commune(df))
    assert rows(tables["code_departement"]) == rows(gold.price_by_department(df))


def test_median_is_the_lower_element(spark):
    df = sales(spark, *[{"id_mutation": f"m{v}", "valeur_fonciere": float(v), "surface_reelle_bati": 1.0} for v in (1, 2, 3, 10)])
    assert gold.price_by_commune(df).first()["median_valeur_fonciere"] == 2.0


@pytest.mark.parametrize("spread", [1, 1000, 10**9])
def test_exact_medians_against_brute_force(spark, spread):
    """One group holds most rows, many of them equal; there are negative values too."""
    rng = random.Random(spread)
    data = [("hot" if rng.random() < 0.7 else rng.choice("abc"), round(rng.gauss(0, spread), 2)) for _ in range(3000)]
    data += [(None, 5.0), ("a", None), ("b", float("nan"))]
    groups = {}
    for g, v in data:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    expected = {g: statistics.median_low(v) for g, v in groups.items()}
    out = rollup.exact_medians(spark.createDataFrame(data, "g string, v double"), ["g"], "v")
    assert {r["g"]: r["median_v"] for r in out.collect()} == expected


def test_exact_medians_of_tiny_and_crowded_values(spark):
    rng = random.Random(9)
    data = [("tiny", rng.random() * 1e-4) for _ in range(2001)] + [("near", 1 + rng.random() * 1e-5) for _ in range(2000)]
    data += [("far", x) for x in (0.0, 1e-300, 1e300, float("inf"), -1e-300)] + [("same", 7.0)] * 50
    groups = {}
    for g, v in data:
        groups.setdefault(g, []).append(v)
    out = rollup.exact_medians(spark.createDataFrame(data, "g string, v double"), ["g"], "v", most=3)
    assert {r["g"]: r["median_v"] for r in out.collect()} == {g: statistics.median_low(v) for g, v in groups.items()}


def test_grain_keeps_value_once(spark):
    df = sales(spark, {"surface_reelle_bati": 10.0}, {"surface_reelle_bati": 15.0}, {"id_mutation": "other"})
    grain = rollup.to_transaction_grain(df, m.PRICE_COLUMNS.grain, "valeur_fonciere", "surface_reelle_bati")
    assert sorted((r["id_mutation"], r["valeur_fonciere"], r["surface_reelle_bati"]) for r in grain.collect()) == [
        ("2024-1", 400000.0, 25.0), ("other", 400000.0, 40.0),
    ]


def test_exact_medians_of_values_that_are_one_double(spark):
    from decimal import Decimal

    base = Decimal("1000000000000000000")
    values = [(base + k,) for k in range(40)] + [(Decimal(1),), (base * 2,)]
    df = spark.createDataFrame(values, "v decimal(30,0)").withColumn("g", F.lit("a"))
    got = rollup.exact_medians(df, ["g"], "v", most=5).first()["median_v"]
    assert got == sorted(v for v, in values)[(len(values) - 1) // 2]


def test_price_medians_are_exact_in_large_groups(spark):
    """Beyond 10,000 transactions a group, and of a group whose key is NULL."""
    count = 60_000
    lines = spark.range(count).select(
        F.concat(F.lit("m"), "id").alias("id_mutation"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("7510"), F.col("id") % 3)).alias("code_commune"),
        F.lit("75").alias("code_departement"), F.lit("Vente").alias("nature_mutation"),
        F.lit(day("2024-05-15")).alias("date_mutation"),
        (F.pmod(F.col("id") * 7919, F.lit(100_003)) + 1).cast("double").alias("valeur_fonciere"),
        F.lit(2.0).alias("surface_reelle_bati"),
    )
    groups = {}
    for i in range(count):
        groups.setdefault(f"7510{i % 3}" if i % 3 else None, []).append(float(i * 7919 % 100_003 + 1))
    values = {g: statistics.median_low(v) for g, v in groups.items()}
    whole = statistics.median_low([x for v in groups.values() for x in v])
    tables = gold.build_gold(lines)
    found = {r["code_commune"]: (r["median_valeur_fonciere"], r["median_price_per_sqm"]) for r in tables["code_commune"].collect()}
    assert found == {g: (v, v / 2) for g, v in values.items()}
    assert [r["median_valeur_fonciere"] for r in tables["code_departement"].collect()] == [whole]
    assert gold.price_by_department(lines).first()["median_price_per_sqm"] == whole / 2


def test_price_medians_rank_nan_last(spark):
    df = sales(spark, *[{"id_mutation": f"m{v}", "valeur_fonciere": float(v), "surface_reelle_bati": 1.0} for v in (1, 2, "nan", "nan")])
    assert gold.price_by_commune(df).first()["median_valeur_fonciere"] == 2.0
