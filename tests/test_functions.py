import datetime as dt

from pyspark.sql import functions as F

from landledger import functions as lf
from tests.conftest import day


def evaluate(spark, values, schema, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_blank_text_is_null_and_other_text_is_kept(spark):
    got = evaluate(spark, ["", "   ", " a ", "07100", None], "string", lf.blank_to_null("c"))
    assert got == [None, None, " a ", "07100", None]


def test_malformed_text_is_null_for_every_type(spark):
    text = ["12", "4.0", "x", None, " 7 "]
    assert evaluate(spark, text, "string", lf.parse_int("c")) == [12, None, None, None, 7]
    numbers = ["1.5", "s", "", "  ", "n/a", "1e3", ".5", "-Infinity", "12d", "-", None]
    expected = [1.5, None, None, None, None, 1000.0, 0.5, float("-inf"), 12.0, None, None]
    assert evaluate(spark, numbers, "string", lf.parse_double("c")) == expected
    assert evaluate(spark, numbers, "string", F.col("c").try_cast("double")) == expected
    dates = ["2024-01-04", "04/01/2024", "2024-02-30"]
    assert evaluate(spark, dates, "string", lf.parse_date("c")) == [day("2024-01-04"), None, None]


def test_decimal_comma(spark):
    text = ["1042000,50", "12.25", "1,234,5", "s", None]
    assert evaluate(spark, text, "string", lf.decimal_comma("c")) == [1042000.5, 12.25, None, None, None]


def test_finite_removes_nan_only(spark):
    assert evaluate(spark, [1.0, float("nan"), None], "double", lf.finite("c")) == [1.0, None, None]


def test_rounding_removes_score_jitter(spark):
    text = ["0.79605528138528140", "0.79605529999999999", "", None]
    assert evaluate(spark, text, "string", lf.round_score("c")) == [0.7961, 0.7961, None, None]


def test_quarter_label(spark):
    dates = [day("2024-01-01"), day("2024-03-31"), day("2024-04-01"), day("2024-12-31"), None]
    assert evaluate(spark, dates, "date", lf.quarter_label("c")) == [
        "2024-Q1", "2024-Q1", "2024-Q2", "2024-Q4", None,
    ]


def test_publication_label_for_every_day_of_two_years(spark):
    start = day("2023-01-01")
    days = [start + dt.timedelta(n) for n in range(731)]

    def expected(d):
        issues = [dt.date(y, m, 1) for y in (2022, 2023, 2024, 2025) for m in (4, 10)]
        return max(i for i in issues if i <= d).strftime("%Y-%m")

    assert evaluate(spark, days, "date", lf.publication_label("c")) == [expected(d) for d in days]
    assert evaluate(spark, [None], "date", lf.publication_label("c")) == [None]


def test_map_key_prefix_then_exact_then_identity(spark):
    prefixes = [lf.PrefixRule("751", "75056"), ("692", "69123"), ("132", "13055")]
    expr = lf.map_key("c", prefixes, {"93059": "93066", "75102": "never"})
    codes = ["75117", "69203", "13208", "01001", "99999", "93059", "75102", None]
    assert evaluate(spark, codes, "string", expr) == [
        "75056", "69123", "13055", "01001", "99999", "93066", "75056", None,
    ]
    assert evaluate(spark, ["a"], "string", lf.map_key("c")) == ["a"]


def test_map_key_is_an_expression(spark):
    df = spark.createDataFrame([("75117",)], "c string")
    assert df.select(lf.map_key(F.col("c"), [("751", "75056")]).alias("p")).first()["p"] == "75056"
