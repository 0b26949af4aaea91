"""Raw files to the enriched, checked sales table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landledger import publication, sinks, sources
from landledger.functions import decimal_comma, map_key, parse_date, parse_double, parse_int
from landledger.operators import dedup, lookup, nested, projection, quality
from landledger.plans import property_model as m
from landledger.session import materialize, scratch_scope

PARTITIONS = m.PARTITIONS


# --- Typing of each source ---------------------------------------------------


def type_sales(raw: DataFrame, nan_to_null: bool = False) -> DataFrame:
    return projection.cast_fields(raw, m.SALE_STRINGS, m.SALE_INTS, m.SALE_DOUBLES, m.SALE_DATES, nan_to_null)


def type_addresses(raw: DataFrame, one_per_address: bool = False, scope: Sequence[str] = ()) -> DataFrame:
    """Geocoding results under their key, prefixed.

    ``scope`` names columns of ``raw`` that a sale must share to see a row, such
    as the year and department whose addresses were geocoded together.

    Addresses are distinct as text but may coincide once typed (``4`` and
    ``0004``). ``one_per_address`` keeps the best-scored of them; otherwise the
    lookup check of the run reports them.
    """
    outputs: dict[str, Column | str] = {"adresse_numero": parse_int("adresse_numero")}
    outputs |= {c: c for c in m.ADDRESS_KEY[1:]}
    outputs |= {f"ban_{c}": parse_double(c) for c in ("longitude", "latitude", "result_score")}
    outputs |= {f"ban_result_{c}": f"result_{c}" for c in m.ADDRESS_TEXT_RESULTS}
    typed = projection.project(raw, outputs | {c: c for c in scope})
    if not one_per_address:
        return typed
    return dedup.latest_per_key(typed, [*m.ADDRESS_KEY, *scope], ["ban_result_score"])


def type_energy(raw: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Newest diagnostic per address identifier (and ``scope``), prefixed.

    Records without an identifier can match no sale and are dropped before
    the ranking.
    """
    prefixed = [
        "numero_dpe", "etiquette_dpe", "etiquette_ges", "surface_habitable_logement",
        "type_batiment", "periode_construction",
    ]
    outputs: dict[str, Column | str] = {"identifiant_ban": "identifiant_ban"}
    outputs |= {f"dpe_{c}": c for c in prefixed}
    outputs["dpe_date_etablissement_dpe"] = parse_date("date_etablissement_dpe")
    return dedup.latest_per_key(
        projection.project(raw, outputs | {c: c for c in scope}),
        ["identifiant_ban", *scope],
        ["dpe_date_etablissement_dpe", "dpe_numero_dpe"],
        keep_null_keys=False,
    )


def type_incomes(raw: DataFrame, departments: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """Commune incomes of ``departments``; suppressed cells are NULL.

    With ``scope`` the department that a commune code starts with is added.
    """
    outputs: dict[str, Column | str] = {"code_commune": m.INCOME_KEY}
    outputs |= {name: parse_int(c) for c, name in m.INCOME_INTS.items()}
    outputs |= {name: decimal_comma(c) for c, name in m.INCOME_DOUBLES.items()}
    incomes = projection.with_prefix(projection.project(raw, outputs), "code_commune", departments)
    longest_first = sorted(departments, key=len, reverse=True)
    department = F.coalesce(*[F.when(F.col("code_commune").startswith(d), F.lit(d)) for d in longest_first])
    return incomes.withColumns({c: department for c in scope})


def flatten_snapshot(raw: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Communes of administrative snapshots with their region (and ``scope``)."""
    return nested.flatten(
        raw,
        "communes",
        {
            "code_commune_insee": "code",
            "geo_commune_nom": "nom",
            "geo_commune_population": "population",
            "geo_epci_nom": "epci.nom",
            "geo_centre_longitude": nested.array_item("item.centre.coordinates", 0),
            "geo_centre_latitude": nested.array_item("item.centre.coordinates", 1),
        },
        {"geo_region_nom": "region.nom", **{c: c for c in scope}},
    )


def parent_commune(code: str = "code_commune") -> Column:
    return map_key(code, m.DISTRICT_PREFIXES, m.MERGED_COMMUNES)


def geocoding_input(raw_sales: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Numbered distinct addresses to send to a geocoder; rows without a street are left out.

    With ``scope`` (year and department) each scope has its own addresses,
    numbered from 0, as each is geocoded on its own. The numbers over all rows
    are shifted by the first of their scope, one narrow row per scope.
    """
    keys = [*scope, *m.ADDRESS_KEY]
    numbered = dedup.number_rows(dedup.unique_keys(raw_sales, keys, ["adresse_nom_voie"]), keys)
    if not scope:
        return numbered
    numbered = materialize(numbered, "geocoding")
    firsts = numbered.groupBy(*scope).agg(F.min("id").alias("_first"))
    return numbered.join(firsts, list(scope)).select((F.col("id") - F.col("_first")).alias("id"), *keys)


# --- Enrichment --------------------------------------------------------------


@dataclass
class Lookups:
    """The typed lookup sides of one run."""

    addresses: DataFrame
    energy: DataFrame
    incomes: DataFrame
    communes: DataFrame


@dataclass
class JoinReport:
    """Observed counts, filled when the enriched relation is written."""

    observations: dict[str, Observation] = field(default_factory=dict)

    def lines(self) -> list[str]:
        out = []
        for name, observation in self.observations.items():
            values = ", ".join(f"{k} {v}" for k, v in observation.get.items())
            out.append(f"{name}: {values}")
        return out


def enrich(
    sales: DataFrame,
    sides: Lookups,
    null_safe_address: bool = False,
    report: JoinReport | None = None,
    hot_addresses: DataFrame | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Add address, energy, income and administrative columns to typed sales.

    With ``distinct`` exact duplicates among the sales are dropped on the way.

    The energy key is an address result, so energy is looked up for the
    addresses and the pair is then looked up for the sales: the same rows as
    one lookup after the other, but the sales are shuffled once instead of
    twice. The commune tables are broadcast when Spark or :func:`run_silver`
    has sized them.
    """

    def watch(df: DataFrame, matched: str, name: str) -> DataFrame:
        if report is None:
            return df
        watched, report.observations[name] = lookup.observe_matches(df, matched, name)
        return watched

    def scope(side: DataFrame) -> list[str]:
        return [c for c in PARTITIONS if c in side.columns]

    def add(left: DataFrame, side: DataFrame, left_key: Column | str, right_key: str) -> DataFrame:
        """Lookup by one key within the scope of ``side``."""
        renamed = side.withColumnsRenamed({c: f"_side_{c}" for c in (right_key, *scope(side))})
        return lookup.lookup_join(
            left,
            renamed,
            left_on=[left_key, *scope(side)],
            right_on=[f"_side_{c}" for c in (right_key, *scope(side))],
        )

    addresses = add(sides.addresses, sides.energy, "ban_result_id", "identifiant_ban")
    counted = None
    if distinct and report is not None:
        before, counted = Observation("sales_before"), Observation("sales_after")
        sales = sales.observe(before, F.count(F.lit(1)).alias("rows"))
        report.observations |= {"typed": before, "deduplicated": counted}
    out = lookup.lookup_join(
        sales,
        addresses,
        [*m.ADDRESS_KEY, *scope(addresses)],
        null_safe=null_safe_address,
        hot=hot_addresses,
        distinct=distinct,
        kept=counted,
    )
    out = watch(out, "ban_result_status", "addresses")
    out = watch(out, "dpe_etiquette_dpe", "energy")
    out = add(out, sides.incomes, "code_commune", "code_commune")
    out = watch(out, "filosofi_revenu_median", "incomes")
    out = add(out, sides.communes, parent_commune(), "code_commune_insee")
    return watch(out, "geo_commune_nom", "communes")


# --- One job over many partitions --------------------------------------------


@dataclass(frozen=True)
class RawLayout:
    """Where the raw files are; ``root`` holds one directory per dataset."""

    root: str
    publication: str
    energy_date: str
    snapshot_date: str
    incomes: str = m.INCOME_ARCHIVE


def _partition_paths(
    layout: RawLayout,
    dataset: str,
    heads: dict[str, str],
    years: Sequence[int],
    departments: Sequence[str],
    suffix: str,
) -> list[str]:
    """Files of the asked partitions, by the layout's naming rule."""
    paths = []
    for d in departments:
        for parts in [{"year": y} for y in years] or [{}]:
            keys = {**heads, **parts, "department": d}
            paths.append(sources.object_path(layout.root, dataset, keys, f"{d}{suffix}"))
    return paths


def read_sales(
    spark: SparkSession,
    layout: RawLayout,
    years: Sequence[int] = (),
    departments: Sequence[str] = (),
    asked: DataFrame | None = None,
) -> DataFrame:
    """Raw sale lines of all asked partitions with ``year`` and ``department`` columns.

    Either years and departments, whose files are named by rule, or a table
    ``asked`` of both, which prunes the folders of the dataset at run time.
    """
    base = sources.object_path(layout.root, m.SALES, {"publication": layout.publication})
    heads = {"publication": layout.publication}
    path = _partition_paths(layout, m.SALES, heads, years, departments, ".csv.gz") if asked is None else base
    scanned = sources.scan_csv(spark, path, m.SALE_COLUMNS, partitions=PARTITIONS, base_path=base)
    return scanned if asked is None else sources.asked_only(scanned, asked, PARTITIONS)


def read_lookups(
    spark: SparkSession,
    layout: RawLayout,
    years: Sequence[int],
    departments: Sequence[str],
    one_per_address: bool = False,
    asked: DataFrame | None = None,
) -> Lookups:
    """All lookup sides of the asked partitions, typed; with ``asked`` as in :func:`read_sales`.

    Each row keeps the partition it comes from, so that a run over many
    partitions gives every sale the rows that a run over its own partition
    would: an address geocoded for two years has a result for each.
    """

    def read(scan, dataset: str, heads: dict[str, str], keys: list[str], suffix: str, **options) -> DataFrame:
        base = sources.object_path(layout.root, dataset, heads)
        in_years = years if "year" in keys else ()
        path = _partition_paths(layout, dataset, heads, in_years, departments, suffix) if asked is None else base
        scanned = scan(spark, path, partitions=keys, base_path=base, **options)
        return scanned if asked is None else sources.asked_only(scanned, asked, keys)

    by_department, published = PARTITIONS[1:], {"publication": layout.publication}
    addresses = read(sources.scan_csv, m.ADDRESSES, published, PARTITIONS, ".csv", columns=m.ADDRESS_COLUMNS)
    energy = read(
        sources.scan_jsonl, m.ENERGY, {"extraction_date": layout.energy_date}, by_department, ".jsonl", schema=m.ENERGY_SCHEMA
    )
    snapshots = read(
        sources.scan_json_document, m.SNAPSHOTS, {"extraction_date": layout.snapshot_date}, by_department, ".json",
        schema=m.SNAPSHOT_SCHEMA,
    )
    incomes = sources.scan_zip_csv(
        spark,
        sources.object_path(layout.root, layout.incomes, {}),
        m.INCOME_MEMBER,
        [m.INCOME_KEY, *m.INCOME_INTS, *m.INCOME_DOUBLES],
    )
    return Lookups(
        type_addresses(addresses, one_per_address, PARTITIONS),
        type_energy(energy, by_department),
        type_incomes(incomes, departments, by_department),
        flatten_snapshot(snapshots, by_department),
    )


def build_silver(
    sales: DataFrame,
    sides: Lookups,
    null_safe_address: bool = False,
    report: JoinReport | None = None,
    hot_addresses: DataFrame | None = None,
    nan_to_null: bool = False,
) -> DataFrame:
    """Raw sales to enriched sales: type, drop exact duplicates, enrich. Lazy."""
    return enrich(type_sales(sales, nan_to_null), sides, null_safe_address, report, hot_addresses, distinct=True)


def hinted(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, lookup.SideSize]:
    """A commune table, measured, and with a broadcast hint if it is small."""
    size = lookup.measure_side(df, keys)
    return lookup.broadcast_within(df, size), size


def run_silver(
    spark: SparkSession,
    layout: RawLayout,
    target: str,
    years: Sequence[int] = (),
    departments: Sequence[str] = (),
    one_per_address: bool = False,
    null_safe_address: bool = False,
    hot_share: float | None = None,
    show=print,
    nan_to_null: bool = False,
    asked: DataFrame | None = None,
    one_switch: bool = False,
) -> list:
    """Build, check and publish the asked partitions in one job chain.

    The enriched rows are written once to the shared scratch folder; the gate
    reads only the rule columns of that table, and the published partitions are
    copied from it. Every asked partition is judged, also one without rows, and
    nothing is published if a blocking rule fails. With ``hot_share`` the
    addresses that hold at least that share of the sales are found first and
    salted in the lookup. A table ``asked`` (year, department) takes the place of
    years and departments; its partitions are found at run time. With
    ``one_switch`` the target is a published table
    (:mod:`landledger.publication`), whose partitions change all at once. The
    run's scratch tables are removed at its end, its shuffle files one step after
    the other.
    """
    with scratch_scope(spark):
        if asked is None:
            owned = [(str(y), d) for y in years for d in departments]
        else:
            # one row per asked partition
            asked = materialize(asked.select(*[F.col(c).cast("string").alias(c) for c in PARTITIONS]).distinct(), "asked")
            owned = sorted(tuple(r) for r in asked.collect())
            departments = sorted({d for _, d in owned})
        sides = read_lookups(spark, layout, years, departments, one_per_address, asked)
        sides.incomes, income_size = hinted(materialize(sides.incomes, "incomes"), ["code_commune", "department"])
        sides.communes, commune_size = hinted(
            materialize(sides.communes, "communes"), ["code_commune_insee", "department"]
        )
        report = JoinReport()
        sales = read_sales(spark, layout, years, departments, asked)
        hot = None
        if hot_share:
            keys = [*m.ADDRESS_KEY, *PARTITIONS]
            typed = type_sales(sales, nan_to_null)
            hot = materialize(lookup.hot_keys(typed, keys, hot_share, "_rows", null_safe_address), "hot")
        staged = materialize(build_silver(sales, sides, null_safe_address, report, hot, nan_to_null), "silver")
        for line in report.lines():
            show(line)

        asked = spark.createDataFrame(owned, ", ".join(f"{c} string" for c in PARTITIONS))
        results = quality.run_gate(staged, m.all_rules("department", "year"), PARTITIONS, show, asked)
        matching = (null_safe_address, nan_to_null)
        results += quality.enforce(_conservation(sales, staged, sides, income_size, commune_size, *matching), show)
        if one_switch:
            publication.publish(staged, target, PARTITIONS, owned)
        else:
            sinks.replace_partitions(staged, target, PARTITIONS, owned)
        return results


def _conservation(sales, staged, sides, income_size, commune_size, null_safe, nan_to_null):
    """Rule 4.2. Lookups with unique keys prove it; otherwise rows are counted.

    NULL address keys count where the join lets them match.
    """
    keys = [*m.ADDRESS_KEY, *PARTITIONS]
    unique = quality.unique_lookup(sides.addresses, keys, "addresses", null_safe).first()
    if unique["passed"] and income_size.surplus == 0 and commune_size.surplus == 0:
        return [quality.proven_conservation()]
    before = dedup.drop_exact_duplicates(type_sales(sales, nan_to_null))
    return quality.row_conservation(before, staged).collect()
