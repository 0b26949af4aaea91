import csv
import gzip
import io
import json
import os
import zipfile

import pytest

from landledger import __main__ as cli
from landledger.operators.quality import QualityGateError
from landledger.plans import gold, silver
from landledger.plans import property_model as m
from landledger.session import CLEANUP, checkpoint_dir, materialize
from landledger.sources import scan_table
from tests.conftest import day

PUBLICATION, ENERGY_DATE, SNAPSHOT_DATE = "2026-04", "2026-09-17", "2026-09-18"


def csv_text(columns, records, sep=","):
    out = io.StringIO()
    writer = csv.DictWriter(out, columns, restval="", delimiter=sep, lineterminator="\n")
    writer.writeheader()
    writer.writerows(records)
    return out.getvalue()


def sale(n, dept, commune, **more):
    base = {
        "id_mutation": f"2024-{dept}-{n}", "date_mutation": "2024-05-15", "numero_disposition": "000001",
        "nature_mutation": "Vente", "valeur_fonciere": "400000,50", "adresse_numero": str(n),
        "adresse_nom_voie": "RUE A", "code_postal": f"{dept}001", "code_commune": commune, "nom_commune": "X",
        "code_departement": dept, "id_parcelle": f"P{n}", "type_local": "Appartement", "surface_reelle_bati": "40",
    }
    return {**base, **more}


def address(n, dept, commune, **more):
    base = {
        "id": str(n), "adresse_numero": f"{n:04d}", "adresse_nom_voie": "RUE A", "code_postal": f"{dept}001",
        "code_commune": commune, "longitude": "2.5", "latitude": "", "result_score": "0.9",
        "result_id": f"{commune}_{n}", "result_status": "ok",
    }
    return {**base, **more}


class Raw:
    """A raw layout of two departments on disk."""

    def __init__(self, root):
        self.root = root
        self.sales = {
            "75": [sale(1, "75", "75101"), sale(1, "75", "75101"), sale(2, "75", "75102", adresse_numero=""),
                   sale(3, "75", "75102", valeur_fonciere="60000000", surface_reelle_bati="120"),
                   sale(3, "75", "75102", valeur_fonciere="60000000", surface_reelle_bati="30", id_parcelle="P3b")],
            "93": [sale(1, "93", "93059"), sale(2, "93", "93066", adresse_nom_voie="", surface_reelle_bati="")],
        }
        self.addresses = {
            "75": [address(1, "75", "75101"), address(3, "75", "75102", result_score="oops")],
            "93": [address(1, "93", "93059")],
        }
        self.energy = {
            "75": [
                {"numero_dpe": "1", "identifiant_ban": "75101_1", "etiquette_dpe": "G", "date_etablissement_dpe": "2020-01-01"},
                {"numero_dpe": "2", "identifiant_ban": "75101_1", "etiquette_dpe": "B", "date_etablissement_dpe": "2023-01-01",
                 "surface_habitable_logement": 38.5},
                {"numero_dpe": "3", "identifiant_ban": "75101_1", "etiquette_dpe": "A", "date_etablissement_dpe": None},
                {"numero_dpe": "4", "identifiant_ban": None, "etiquette_dpe": "A", "date_etablissement_dpe": "2024-01-01"},
            ],
            "93": [{"numero_dpe": "9", "identifiant_ban": "93059_1", "etiquette_dpe": "E", "date_etablissement_dpe": "bad"}],
        }
        self.incomes = [
            {"CODGEO": "75101", "NBMEN21": "10", "NBPERS21": "s", "Q221": "31234,5"},
            {"CODGEO": "75102", "NBMEN21": "11", "NBPERS21": "20", "Q221": "30000"},
            {"CODGEO": "93059", "NBMEN21": "s", "NBPERS21": "s", "Q221": "18000"},
            {"CODGEO": "93066", "NBMEN21": "12", "NBPERS21": "30", "Q221": "17000"},
            {"CODGEO": "01001", "NBMEN21": "1", "NBPERS21": "1", "Q221": "1"},
        ]
        self.communes = {
            "75": [{"code": "75056", "nom": "Paris", "population": 2103778, "epci": {"nom": "Métropole"},
                    "centre": {"coordinates": [2.34, 48.86]}}],
            "93": [{"code": "93066", "nom": "Saint-Denis", "population": 5}],
        }

    def put(self, path, content):
        target = self.root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)

    def write(self, year=2024):
        for d in self.sales:
            place = f"publication={PUBLICATION}/year={year}/department={d}/{d}.csv"
            self.put(f"dvf/{place}.gz", gzip.compress(csv_text(m.SALE_COLUMNS, self.sales[d]).encode()))
            self.put(f"ban/{place}", csv_text(m.ADDRESS_COLUMNS, self.addresses[d]).encode())
            lines = "".join(json.dumps(r) + "\n" for r in self.energy[d])
            self.put(f"dpe/extraction_date={ENERGY_DATE}/department={d}/{d}.jsonl", lines.encode())
            document = {"communes": self.communes[d], "department": {"code": d}, "region": {"nom": "Île-de-France"}}
            self.put(f"geo/extraction_date={SNAPSHOT_DATE}/department={d}/{d}.json",
                     json.dumps(document, indent=2, ensure_ascii=False).encode())
        columns = [m.INCOME_KEY, *m.INCOME_INTS, *m.INCOME_DOUBLES, "UNUSED"]
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr("FILO2021_DEC_COM.csv", "other")
            archive.writestr(m.INCOME_MEMBER, csv_text(columns, self.incomes, ";"))
        self.put(m.INCOME_ARCHIVE, out.getvalue())
        return self

    @property
    def layout(self):
        return silver.RawLayout(str(self.root), PUBLICATION, ENERGY_DATE, SNAPSHOT_DATE)


@pytest.fixture
def raw(tmp_path):
    return Raw(tmp_path / "raw").write()


def run(spark, raw, target, departments=("75", "93"), **options):
    return silver.run_silver(spark, raw.layout, str(target), [2024], list(departments), show=lambda line: None, **options)


def test_silver_of_two_departments_in_one_run(spark, raw, tmp_path):
    results = run(spark, raw, tmp_path / "silver")
    assert len(results) == 2 * 15 + 1 and results[-1]["rule_id"] == "4.2"
    table = spark.read.parquet(f"{tmp_path}/silver")
    assert len(table.columns) == 71 + 2
    got = {(r["id_mutation"], r["id_parcelle"]): r for r in table.collect()}
    assert len(got) == 6 == table.count()

    first = got["2024-75-1", "P1"]
    assert (first["valeur_fonciere"], first["date_mutation"], first["adresse_numero"]) == (400000.5, day("2024-05-15"), 1)
    assert (first["ban_longitude"], first["ban_latitude"], first["ban_result_id"]) == (2.5, None, "75101_1")
    assert (first["dpe_numero_dpe"], first["dpe_etiquette_dpe"], first["dpe_surface_habitable_logement"]) == ("2", "B", 38.5)
    assert (first["filosofi_nb_personnes"], first["filosofi_revenu_median"]) == (None, 31234.5)
    assert (first["geo_commune_nom"], first["geo_epci_nom"], first["geo_centre_latitude"]) == ("Paris", "Métropole", 48.86)

    unnumbered = got["2024-75-2", "P2"]
    assert unnumbered["ban_result_status"] is None and unnumbered["geo_commune_nom"] == "Paris"
    scored = got["2024-75-3", "P3"]
    assert scored["ban_result_status"] == "ok" and scored["ban_result_score"] is None and scored["dpe_numero_dpe"] is None
    merged = got["2024-93-1", "P1"]
    assert (merged["geo_commune_nom"], merged["filosofi_revenu_median"], merged["dpe_etiquette_dpe"]) == ("Saint-Denis", 18000.0, "E")


def test_running_again_replaces_only_its_partitions(spark, raw, tmp_path):
    target = tmp_path / "silver"
    run(spark, raw, target)
    raw.sales["93"] = raw.sales["93"][:1]
    raw.write()
    for _ in range(2):
        run(spark, raw, target, ["93"])
    table = scan_table(spark, str(target), m.PARTITIONS)
    counts = {(r["year"], r["department"]): r["count"] for r in table.groupBy("year", "department").count().collect()}
    assert counts == {("2024", "75"): 4, ("2024", "93"): 1}


def test_an_asked_partition_without_rows_fails_the_gate(spark, raw, tmp_path):
    run(spark, raw, tmp_path / "silver")
    raw.sales["93"] = []
    raw.write()
    with pytest.raises(QualityGateError) as caught:
        run(spark, raw, tmp_path / "silver")
    assert {(r["department"], r["rule_id"]) for r in caught.value.failed} == {("93", "5-Filosofi"), ("93", "5-geo")}


def test_null_safe_lookup_that_multiplies_rows_fails_rule_4_2(spark, raw, tmp_path):
    raw.addresses["75"] += [address(2, "75", "75102", adresse_numero="", result_id="x"), address(5, "75", "75102", adresse_numero=" ", result_id="y")]
    raw.write()
    run(spark, raw, tmp_path / "plain", ["75"])
    with pytest.raises(QualityGateError) as caught:
        run(spark, raw, tmp_path / "safe", ["75"], null_safe_address=True)
    assert [(r["rule_id"], r["violation_count"]) for r in caught.value.failed] == [("4.2", 1)]
    run(spark, raw, tmp_path / "one", ["75"], null_safe_address=True, one_per_address=True)
    assert scan_table(spark, f"{tmp_path}/one").count() == 4


def test_one_run_over_two_years_equals_two_runs(spark, raw, tmp_path):
    """Each year has its own geocoding result for the same address."""
    raw.sales["75"] = [sale(1, "75", "75101", date_mutation="2023-02-03")]
    raw.addresses["75"] = [address(1, "75", "75101", result_score="0.6")]
    raw.write(year=2023)
    raw.sales["75"] = [sale(1, "75", "75101"), sale(2, "75", "92012")]
    raw.addresses["75"] = [address(1, "75", "75101", result_score="0.8")]
    raw.incomes.append({"CODGEO": "92012", "NBMEN21": "1", "NBPERS21": "1", "Q221": "9"})
    raw.sales["93"][0]["code_commune"] = "93066"
    raw.write()
    sides = silver.read_lookups(spark, raw.layout, [2023, 2024], ["75", "93"])
    sales = silver.read_sales(spark, raw.layout, [2023, 2024], ["75"])
    together = silver.build_silver(sales, sides)
    assert {(r["year"], r["id_mutation"]): (r["ban_result_score"], r["filosofi_revenu_median"]) for r in together.collect()} == {
        ("2023", "2024-75-1"): (0.6, 31234.5), ("2024", "2024-75-1"): (0.8, 31234.5), ("2024", "2024-75-2"): (None, None),
    }
    apart = [
        silver.build_silver(
            silver.read_sales(spark, raw.layout, [y], ["75"]), silver.read_lookups(spark, raw.layout, [y], ["75"])
        )
        for y in (2023, 2024)
    ]
    both = apart[0].unionByName(apart[1])
    assert both.exceptAll(together).isEmpty() and together.exceptAll(both).isEmpty()


def test_a_blocking_rule_publishes_nothing(spark, raw, tmp_path):
    raw.sales["93"][0]["nature_mutation"] = "Don"
    raw.write()
    with pytest.raises(QualityGateError) as caught:
        run(spark, raw, tmp_path / "silver")
    assert [(r["department"], r["rule_id"], r["violation_count"]) for r in caught.value.failed] == [("93", "2.1", 1)]
    assert not (tmp_path / "silver").exists()


def test_addresses_that_coincide_once_typed_are_caught_or_reduced(spark, raw, tmp_path):
    raw.addresses["75"].append(address(1, "75", "75101", adresse_numero="1", result_score="0.4", result_status="weak"))
    raw.write()
    with pytest.raises(QualityGateError) as caught:
        run(spark, raw, tmp_path / "a")
    assert [(r["rule_id"], r["violation_count"]) for r in caught.value.failed] == [("4.2", 1)]
    run(spark, raw, tmp_path / "b", one_per_address=True)
    rows = spark.read.parquet(f"{tmp_path}/b").filter("id_mutation = '2024-75-1'").collect()
    assert [r["ban_result_status"] for r in rows] == ["ok"]


def test_null_safe_address_option(spark, raw, tmp_path):
    raw.addresses["75"].append(address(2, "75", "75102", adresse_numero=""))
    raw.write()
    run(spark, raw, tmp_path / "plain", ["75"])
    run(spark, raw, tmp_path / "safe", ["75"], null_safe_address=True)
    status = {
        name: spark.read.parquet(f"{tmp_path}/{name}").filter("id_mutation = '2024-75-2'").first()["ban_result_status"]
        for name in ("plain", "safe")
    }
    assert status == {"plain": None, "safe": "ok"}


def test_salted_run_gives_the_same_table(spark, raw, tmp_path):
    run(spark, raw, tmp_path / "a")
    run(spark, raw, tmp_path / "b", hot_share=0.1)
    a, b = (spark.read.parquet(f"{tmp_path}/{n}") for n in "ab")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_gold_and_the_command_line(spark, raw, tmp_path, capsys):
    arguments = ["silver", "--root", str(raw.root), "--target", f"{tmp_path}/silver", "--year", "2024", "--dept", "75", "93",
                 "--publication", PUBLICATION, "--dpe-extraction-date", ENERGY_DATE, "--geo-extraction-date", SNAPSHOT_DATE]
    assert cli.main(arguments) == 0
    assert "deduplicated: rows 6" in capsys.readouterr().out
    assert cli.main(["gold", "--silver", f"{tmp_path}/silver", "--commune-target", f"{tmp_path}/communes",
                     "--department-target", f"{tmp_path}/departments"]) == 0
    communes = {r["code_commune"]: r for r in spark.read.parquet(f"{tmp_path}/communes").collect()}
    assert set(communes) == {"75101", "75102", "93059"}
    assert communes["75102"]["nb_transactions"] == 2
    departments = {r["code_departement"]: r["nb_transactions"] for r in spark.read.parquet(f"{tmp_path}/departments").collect()}
    assert departments == {"75": 3, "93": 1}

    raw.sales["75"][0]["date_mutation"] = "2031-01-01"
    raw.write()
    assert cli.main(arguments) == 1


def test_geocoding_input_numbers_distinct_addresses_with_a_street(spark, raw):
    sales = silver.read_sales(spark, raw.layout, [2024], ["75", "93"])
    got = sorted(tuple(r) for r in silver.geocoding_input(sales).collect())
    assert [r[0] for r in got] == [0, 1, 2, 3]
    assert {r[1:] for r in got} == {
        ("1", "RUE A", "75001", "75101"), (None, "RUE A", "75001", "75102"),
        ("3", "RUE A", "75001", "75102"), ("1", "RUE A", "93001", "93059"),
    }


def test_geocoding_input_numbers_each_scope_on_its_own(spark, raw):
    sales = silver.read_sales(spark, raw.layout, [2024], ["75", "93"])
    got = silver.geocoding_input(sales, m.PARTITIONS).collect()
    assert sorted((r["department"], r["id"]) for r in got) == [("75", 0), ("75", 1), ("75", 2), ("93", 0)]


def test_enriching_by_pairs_equals_one_lookup_after_the_other(spark, raw):
    from landledger.operators import lookup

    sides = silver.read_lookups(spark, raw.layout, [2024], ["75", "93"])
    sales = silver.type_sales(silver.read_sales(spark, raw.layout, [2024], ["75", "93"]))
    chained = lookup.lookup_join(sales, sides.addresses, [*m.ADDRESS_KEY, *silver.PARTITIONS])
    energy = sides.energy.withColumnRenamed("department", "of_department")
    chained = lookup.lookup_join(
        chained, energy, left_on=["ban_result_id", "department"], right_on=["identifiant_ban", "of_department"]
    )
    paired = silver.enrich(sales, sides).select(*chained.columns)
    assert chained.exceptAll(paired).isEmpty() and paired.exceptAll(chained).isEmpty()


def test_commune_lookups_are_broadcast_and_sales_shuffled_twice(spark, raw):
    """One shuffle of the sales for the duplicates, one for the addresses."""
    sides = silver.read_lookups(spark, raw.layout, [2024], ["75", "93"])
    sides.incomes, _ = silver.hinted(materialize(sides.incomes, "incomes"), ["code_commune", "department"])
    sides.communes, _ = silver.hinted(materialize(sides.communes, "communes"), ["code_commune_insee", "department"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = silver.build_silver(silver.read_sales(spark, raw.layout, [2024], ["75", "93"]), sides)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 2
    with_sales = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "adresse_nom_voie" in line]
    assert text.count("SortMergeJoin") == 2
    assert len(with_sales) <= 2


def test_runs_remove_their_scratch_tables(spark, raw, tmp_path):
    """Also a run that is refused; what they publish stays."""
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    run(spark, raw, tmp_path / "silver", hot_share=0.1)
    gold.run_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/communes", f"{tmp_path}/departments")
    raw.sales["93"][0]["nature_mutation"] = "Don"
    raw.write()
    with pytest.raises(QualityGateError):
        run(spark, raw, tmp_path / "refused")
    assert set(os.listdir(folder)) == before
    assert spark.conf.get(CLEANUP, None) != "true"
    assert spark.read.parquet(f"{tmp_path}/departments").count() == 2
