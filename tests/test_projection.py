import pytest

from landledger.operators import projection as p
from tests.conftest import day, rows


def test_cast_fields_types_every_listed_column_in_place(spark):
    raw = spark.createDataFrame(
        [("07100", "1042000,50", "000001", "2024-01-04", "x"), ("", " ", "four", "soon", None)],
        "code string, price string, number string, day string, extra string",
    )
    typed = p.cast_fields(raw, strings=["code"], ints=["number"], doubles=["price"], dates=["day"])
    assert [(f.name, f.dataType.simpleString()) for f in typed.schema] == [
        ("code", "string"), ("price", "double"), ("number", "int"), ("day", "date"), ("extra", "string"),
    ]
    assert rows(typed) == [("07100", 1042000.5, 1, day("2024-01-04"), "x"), (None, None, None, None, None)]


def test_cast_fields_is_one_projection(spark):
    raw = spark.range(3).selectExpr(*[f"CAST(id AS STRING) AS c{i}" for i in range(30)])
    plan = p.cast_fields(raw, ints=raw.columns)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 2


def test_cast_fields_nan_option_and_unknown_column(spark):
    raw = spark.createDataFrame([("NaN",)], "price string")
    kept = p.cast_fields(raw, doubles=["price"]).first()["price"]
    assert kept != kept
    assert p.cast_fields(raw, doubles=["price"], nan_to_null=True).first()["price"] is None
    with pytest.raises(ValueError, match="prise"):
        p.cast_fields(raw, doubles=["prise"])


def test_blank_to_null_touches_named_columns_only(spark):
    raw = spark.createDataFrame([(" ", " ")], "a string, b string")
    assert rows(p.blank_to_null(raw, ["a"])) == [(None, " ")]


def test_project_renames_and_evaluates(spark):
    from landledger.functions import decimal_comma

    raw = spark.createDataFrame([("01001", "s"), ("01002", "2,5")], "CODE string, V string")
    assert rows(p.project(raw, {"code": "CODE", "value": decimal_comma("V")})) == [("01001", None), ("01002", 2.5)]


def test_with_prefix(spark):
    raw = spark.createDataFrame([("75101",), ("07501",), ("92001",), (None,)], "c string")
    assert rows(p.with_prefix(raw, "c", ["75"])) == [("75101",)]
    assert rows(p.with_prefix(raw, "c", ["75", "92"])) == [("75101",), ("92001",)]
    assert rows(p.with_prefix(raw, "c", [])) == []


def test_with_positive_drops_missing_zero_and_other_categories(spark):
    raw = spark.createDataFrame(
        [(1, "Vente", 10.0), (2, "Vente", 0.0), (3, "Vente", None), (4, "Echange", 10.0), (5, None, 10.0), (6, "Vente", -1.0)],
        "id int, kind string, v double",
    )
    assert [r[0] for r in rows(p.with_positive(raw, ["v"], {"kind": "Vente"}))] == [1]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "Vente", 10.0, "x")], "id int, kind string, v double, other string").write.parquet(f"{tmp_path}/t")
    kept = p.with_positive(spark.read.parquet(f"{tmp_path}/t"), ["v"], {"kind": "Vente"}).select("id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(kind,Vente)" in plan and "GreaterThan(v,0.0)" in plan
    assert "ReadSchema: struct<id:int,kind:string,v:double>" in plan


def test_round_columns_keeps_blank_as_null(spark):
    raw = spark.createDataFrame([("0.79605528138528140", "a"), ("", "b"), (None, "c")], "s string, k string")
    assert rows(p.round_columns(raw, ["s"])) == [(0.7961, "a"), (None, "b"), (None, "c")]


def test_with_ratio(spark):
    raw = spark.createDataFrame([(10.0, 4.0)], "a double, b double")
    assert p.with_ratio(raw, "a", "b", "r").first()["r"] == 2.5
