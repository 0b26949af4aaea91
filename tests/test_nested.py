from collections import Counter

from pyspark.sql import functions as F

from landledger import sinks, sources
from landledger.operators import nested
from landledger.plans import property_model as m
from landledger.plans.silver import flatten_snapshot
from tests.conftest import rows


def test_array_item_beyond_the_end_is_null(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([],), (None,)], "a array<double>")
    got = df.select(nested.array_item("a", 1)).collect()
    assert [r[0] for r in got] == [2.0, None, None]


def test_flatten_carries_parents_and_skips_empty_arrays(spark):
    df = spark.createDataFrame(
        [(("R",), [("a", 1), ("b", None)]), (("S",), []), (("T",), None)],
        "region struct<nom string>, communes array<struct<nom string, n int>>",
    )
    out = nested.flatten(df, "communes", {"commune": "nom", "n": "n"}, {"region": "region.nom"})
    assert rows(out) == [("a", 1, "R"), ("b", None, "R")]


def test_nest_gives_one_document_per_parent_or_slice(spark):
    parents = spark.createDataFrame([("hot",), ("small",), ("none",)], "key string")
    items = [("hot", i % 5) for i in range(100)] + [("small", 1)]  # many equal children
    children = spark.createDataFrame(items, "k string, v int")
    whole = nested.nest(parents, children, "key", "k", "items", ["v"])
    assert rows(whole.select("key", F.size("items"))) == [("hot", 100), ("none", 0), ("small", 1)]
    sliced = nested.nest(parents, children, "key", "k", "items", ["v"], slice_by=F.col("v") % 2)
    assert rows(sliced.select("key", "slice", F.size("items"))) == [
        ("hot", 0, 60), ("hot", 1, 40), ("none", None, 0), ("small", 1, 1),
    ]
    for out in (whole, sliced):
        flat = nested.flatten(out, "items", {"k": "k", "v": "v"})
        assert Counter(tuple(r) for r in flat.collect()) == Counter(items)


def test_snapshot_round_trip_through_files(spark, tmp_path):
    departments = spark.createDataFrame([("Paris", "75", "11"), ("Ain", "01", "84")], "nom string, code string, codeRegion string")
    regions = spark.createDataFrame([("Île-de-France", "11"), ("Auvergne", "84")], "nom string, code string")
    communes = spark.createDataFrame(
        [
            ("Paris", "75056", "75", 2103778, ("Métropole",), ([2.34, 48.86],)),
            ("Bourg", "01053", "01", None, None, ([5.2],)),
        ],
        "nom string, code string, codeDepartement string, population bigint, epci struct<nom string>,"
        " centre struct<coordinates array<double>>",
    )
    path = f"{tmp_path}/snapshots"
    nested.nest_snapshot(departments, regions, communes).write.option("maxRecordsPerFile", 1).json(path)
    flat = flatten_snapshot(sources.scan_json_document(spark, path, m.SNAPSHOT_SCHEMA))
    assert flat.columns == [
        "code_commune_insee", "geo_commune_nom", "geo_commune_population", "geo_epci_nom",
        "geo_centre_longitude", "geo_centre_latitude", "geo_region_nom",
    ]
    assert rows(flat) == [
        ("01053", "Bourg", None, None, 5.2, None, "Auvergne"),
        ("75056", "Paris", 2103778, "Métropole", 2.34, 48.86, "Île-de-France"),
    ]


def test_pretty_printed_document_without_epci(spark, tmp_path):
    (tmp_path / "01.json").write_text(
        '{\n "communes": [\n  {"code": "01001", "nom": "A", "population": 5}\n ],\n'
        ' "department": {"code": "01"}, "region": {"nom": "R"}\n}\n'
    )
    flat = flatten_snapshot(sources.scan_json_document(spark, f"{tmp_path}/01.json", m.SNAPSHOT_SCHEMA))
    assert rows(flat) == [("01001", "A", 5, None, None, None, "R")]


def test_json_lines_sink_sorts_fields_keeps_nulls_and_counts(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), (None, 2)], "b string, a int")
    assert sinks.write_jsonl(df, f"{tmp_path}/out") == 2
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert sorted(lines) == ['{"a":1,"b":"x"}', '{"a":2,"b":null}']
