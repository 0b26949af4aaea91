"""The whole sales plan on raw text rendered from the test tables.

Order lines stand for sale lines, customers for geocoded addresses, events for
energy diagnostics, nations for communes. Lines with return flag R are doubled
to give exact duplicates; line 4 has no house number, line 6 a foreign postal
code, line 7 no price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger import sinks
from landledger.operators import nested, quality
from landledger.plans import gold, reports, silver
from landledger.plans import property_model as m
from landledger.session import discard, materialize, scratch_path, scratch_scope
from landledger.showcase.registry import Tables, comma, query, shown_means

COMMUNE = """CASE WHEN {n} < 5 THEN concat('7510', {n}) WHEN {n} < 10 THEN concat('6920', {n})
  WHEN {n} < 15 THEN concat('132', {n}) WHEN {n} = 15 THEN '93059' WHEN {n} = 16 THEN '93066'
  ELSE concat('010', {n}) END"""
PARENT = """CASE WHEN {n} < 5 THEN '75056' WHEN {n} < 10 THEN '69123' WHEN {n} < 15 THEN '13055'
  WHEN {n} <= 16 THEN '93066' ELSE concat('010', {n}) END"""
NATURE = "CASE o_orderstatus WHEN 'F' THEN 'Vente' WHEN 'O' THEN 'Echange' ELSE 'Don' END"
LOCAL_TYPE = """CASE p_type WHEN 'ECONOMY' THEN 'Appartement' WHEN 'PROMO' THEN 'Maison'
  WHEN 'SMALL' THEN 'Dépendance' WHEN 'LARGE' THEN 'Garage' END"""
STREET = "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE concat('RUE ', c_mktsegment) END"
POSTAL = "concat(CASE WHEN {line} = 6 THEN '00' ELSE substr({commune}, 1, 2) END, '1', lpad(CAST({n} AS {text}), 2, '0'))"
LABEL = "CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'A' WHEN 'view' THEN 'B' ELSE 'G' END"


def _commune(n: str) -> str:
    return COMMUNE.format(n=n)


def _postal(line: str, n: str, text: str) -> str:
    return POSTAL.format(line=line, n=n, commune=_commune(n), text=text)


def raw_sales(t: Tables) -> DataFrame:
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    once = joined.withColumn("total", comma("o_totalprice")).withColumn("tax", comma("l_tax"))
    copies = F.when(F.col("l_returnflag") == "R", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rendered = {
        "id_mutation": "concat(year(o_orderdate), '-', l_orderkey)",
        "date_mutation": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
        "numero_disposition": "lpad(CAST(l_linenumber AS STRING), 6, '0')",
        "nature_mutation": NATURE,
        "valeur_fonciere": "CASE WHEN l_linenumber = 7 THEN '' ELSE total END",
        "adresse_numero": "CASE WHEN l_linenumber = 4 THEN ' ' ELSE CAST(o_custkey AS STRING) END",
        "adresse_nom_voie": f"coalesce({STREET}, '')",
        "adresse_code_voie": "lpad(CAST(p_size AS STRING), 4, '0')",
        "code_postal": _postal("l_linenumber", "c_nationkey", "STRING"),
        "code_commune": _commune("c_nationkey"),
        "nom_commune": "n_name",
        "code_departement": f"substr({_commune('c_nationkey')}, 1, 2)",
        "id_parcelle": "CAST(l_partkey AS STRING)",
        "lot1_numero": "CAST(l_suppkey AS STRING)",
        "lot1_surface_carrez": "tax",
        "nombre_lots": "CAST(l_linenumber AS STRING)",
        "type_local": LOCAL_TYPE,
        "surface_reelle_bati": "CASE WHEN l_linenumber = 2 THEN '0' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
        "nombre_pieces_principales": "CAST(p_size AS STRING)",
    }
    columns = [F.expr(rendered.get(c, "''")).alias(c) for c in m.SALE_COLUMNS]
    return once.withColumn("copy", F.explode(copies)).select(*columns)


def raw_addresses(t: Tables) -> DataFrame:
    """One geocoding result per customer with a street; no match below zero balance."""
    located = t.customer.filter("c_mktsegment <> 'FURNITURE'")
    rendered = {
        "id": "CAST(c_custkey AS STRING)",
        "adresse_numero": "lpad(CAST(c_custkey AS STRING), 8, '0')",
        "adresse_nom_voie": STREET,
        "code_postal": _postal("0", "c_nationkey", "STRING"),
        "code_commune": _commune("c_nationkey"),
        "longitude": "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING)",
        "latitude": "'n/a'",
        "result_score": "CAST(CAST(abs(c_acctbal) / 10000 AS DECIMAL(18,4)) AS STRING)",
        "result_label": "c_name",
        "result_id": "CASE WHEN c_acctbal >= 0 THEN concat('B', c_custkey) END",
        "result_city": "c_mktsegment",
        "result_status": "CASE WHEN c_acctbal >= 0 THEN 'ok' ELSE 'not-found' END",
    }
    return located.select(*[F.expr(rendered.get(c, "CAST(NULL AS STRING)")).alias(c) for c in m.ADDRESS_COLUMNS])


def raw_energy(t: Tables) -> DataFrame:
    rendered = {
        "numero_dpe": "lpad(CAST(event_id AS STRING), 12, '0')",
        "identifiant_ban": "CASE WHEN event_type <> 'signup' THEN concat('B', user_id) END",
        "etiquette_dpe": LABEL,
        "etiquette_ges": "event_type",
        "surface_habitable_logement": "value",
        "date_etablissement_dpe": "CASE WHEN event_type = 'purchase' THEN 'unknown' ELSE CAST(CAST(ts AS DATE) AS STRING) END",
    }
    return t.events.select(
        *[
            F.expr(rendered.get(f.name, "NULL")).cast(f.dataType).alias(f.name)
            for f in m.ENERGY_SCHEMA.fields
        ]
    )


def raw_incomes(t: Tables) -> DataFrame:
    """Commune table as text; two nations lack it and suppressed cells hold ``s``."""
    totals = t.customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance")
    )
    text = {
        m.INCOME_KEY: _commune("c_nationkey"),
        "NBMEN21": "CAST(n AS STRING)",
        "NBPERS21": "CASE WHEN c_nationkey = 3 THEN 's' ELSE CAST(n * 2 AS STRING) END",
        "Q221": "translate(CAST(balance AS STRING), '.', ',')",
        "GI21": "'0,25'",
        "S80S2021": "'s'",
    }
    wanted = [m.INCOME_KEY, *m.INCOME_INTS, *m.INCOME_DOUBLES]
    return totals.filter("c_nationkey < 23").select(*[F.expr(text.get(c, "''")).alias(c) for c in wanted])


def raw_snapshot(t: Tables) -> DataFrame:
    """Communes of the nations' parent codes, nested under department and region."""
    communes = (
        t.nation.withColumn("code", F.expr(PARENT.format(n="n_nationkey")))
        .groupBy("code")
        .agg(F.min("n_nationkey").alias("first"), F.max("n_nationkey").alias("last"), F.min("n_regionkey").alias("region"))
        .select(
            F.concat(F.lit("C"), "code").alias("nom"),
            "code",
            F.substring("code", 1, 2).alias("codeDepartement"),
            F.col("region").cast("string").alias("region"),
            F.col("last").cast("bigint").alias("population"),
            F.when(F.col("first") < 20, F.struct(F.concat(F.lit("E"), "first").alias("nom"))).alias("epci"),
            F.struct(F.array(F.col("first").cast("double"), F.col("last").cast("double")).alias("coordinates")).alias("centre"),
        )
    )
    departments = communes.groupBy("codeDepartement").agg(F.min("region").alias("codeRegion")).select(
        F.concat(F.lit("D"), "codeDepartement").alias("nom"), F.col("codeDepartement").alias("code"), "codeRegion"
    )
    regions = t.region.select(F.col("r_name").alias("nom"), F.col("r_regionkey").cast("string").alias("code"))
    return nested.nest_snapshot(departments, regions, communes.drop("region"))


def lookups(t: Tables) -> silver.Lookups:
    codes = ["75", "69", "13", "93", "01"]
    incomes, _ = silver.hinted(materialize(silver.type_incomes(raw_incomes(t), codes), "incomes"), ["code_commune"])
    communes, _ = silver.hinted(
        materialize(silver.flatten_snapshot(raw_snapshot(t)), "communes"), ["code_commune_insee"]
    )
    return silver.Lookups(
        silver.type_addresses(raw_addresses(t)), silver.type_energy(raw_energy(t)), incomes, communes
    )


def sales_table(t: Tables) -> DataFrame:
    return silver.build_silver(raw_sales(t), lookups(t))


# Columns that the rendered texts fill; the others are NULL throughout.
FILLED = [
    "id_mutation", "date_mutation", "numero_disposition", "nature_mutation", "valeur_fonciere", "adresse_numero",
    "adresse_nom_voie", "adresse_code_voie", "code_postal", "code_commune", "nom_commune", "code_departement",
    "id_parcelle", "lot1_numero", "lot1_surface_carrez", "nombre_lots", "type_local", "surface_reelle_bati",
    "nombre_pieces_principales", "longitude",
    "ban_longitude", "ban_latitude", "ban_result_score", "ban_result_label", "ban_result_id", "ban_result_city",
    "ban_result_status",
    "dpe_numero_dpe", "dpe_etiquette_dpe", "dpe_etiquette_ges", "dpe_surface_habitable_logement",
    "dpe_date_etablissement_dpe",
    "filosofi_nb_menages", "filosofi_nb_personnes", "filosofi_revenu_median", "filosofi_gini_index",
    "filosofi_s80_s20_ratio",
    "geo_commune_nom", "geo_commune_population", "geo_epci_nom", "geo_centre_longitude", "geo_centre_latitude",
    "geo_region_nom",
]

SALES = f"""
sales AS (
  SELECT DISTINCT concat(year(o_orderdate), '-', l_orderkey) AS id_mutation, CAST(o_orderdate AS DATE) AS date_mutation,
    l_linenumber AS numero_disposition, {NATURE} AS nature_mutation,
    CASE WHEN l_linenumber <> 7 THEN o_totalprice END AS valeur_fonciere,
    CASE WHEN l_linenumber <> 4 THEN CAST(o_custkey AS INTEGER) END AS adresse_numero,
    {STREET} AS adresse_nom_voie, lpad(CAST(p_size AS VARCHAR), 4, '0') AS adresse_code_voie,
    {_postal("l_linenumber", "c_nationkey", "VARCHAR")} AS code_postal, {_commune("c_nationkey")} AS code_commune,
    n_name AS nom_commune, substr({_commune("c_nationkey")}, 1, 2) AS code_departement,
    CAST(l_partkey AS VARCHAR) AS id_parcelle, CAST(l_suppkey AS VARCHAR) AS lot1_numero,
    l_tax AS lot1_surface_carrez, l_linenumber AS nombre_lots, {LOCAL_TYPE} AS type_local,
    CASE WHEN l_linenumber = 2 THEN 0.0::DOUBLE ELSE l_quantity END AS surface_reelle_bati,
    p_size AS nombre_pieces_principales, CAST(NULL AS DOUBLE) AS longitude, c_nationkey AS nation
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
addresses AS (
  SELECT CAST(c_custkey AS INTEGER) AS k1, {STREET} AS k2, {_postal("0", "c_nationkey", "VARCHAR")} AS k3,
    {_commune("c_nationkey")} AS k4, c_acctbal AS ban_longitude, CAST(NULL AS DOUBLE) AS ban_latitude,
    CAST(CAST(abs(c_acctbal) / 10000 AS DECIMAL(18,4)) AS DOUBLE) AS ban_result_score, c_name AS ban_result_label,
    CASE WHEN c_acctbal >= 0 THEN concat('B', c_custkey) END AS ban_result_id, c_mktsegment AS ban_result_city,
    CASE WHEN c_acctbal >= 0 THEN 'ok' ELSE 'not-found' END AS ban_result_status
  FROM customer WHERE c_mktsegment <> 'FURNITURE'),
energy AS (
  SELECT concat('B', user_id) AS e1, lpad(CAST(event_id AS VARCHAR), 12, '0') AS dpe_numero_dpe,
    {LABEL} AS dpe_etiquette_dpe, event_type AS dpe_etiquette_ges, value AS dpe_surface_habitable_logement,
    CASE WHEN event_type <> 'purchase' THEN CAST(ts AS DATE) END AS dpe_date_etablissement_dpe
  FROM events WHERE event_type <> 'signup'
  QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY dpe_date_etablissement_dpe DESC NULLS LAST, event_id DESC NULLS LAST) = 1),
incomes AS (
  SELECT c_nationkey AS i1, CAST(count(*) AS INTEGER) AS filosofi_nb_menages,
    CASE WHEN c_nationkey <> 3 THEN CAST(count(*) * 2 AS INTEGER) END AS filosofi_nb_personnes,
    CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS filosofi_revenu_median,
    0.25::DOUBLE AS filosofi_gini_index, CAST(NULL AS DOUBLE) AS filosofi_s80_s20_ratio
  FROM customer WHERE c_nationkey < 23 GROUP BY c_nationkey),
parents AS (
  SELECT {PARENT.format(n="n_nationkey")} AS g1, concat('C', {PARENT.format(n="n_nationkey")}) AS geo_commune_nom,
    CAST(max(n_nationkey) AS BIGINT) AS geo_commune_population,
    CASE WHEN min(n_nationkey) < 20 THEN concat('E', min(n_nationkey)) END AS geo_epci_nom,
    min(n_nationkey)::DOUBLE AS geo_centre_longitude, max(n_nationkey)::DOUBLE AS geo_centre_latitude,
    min(min(n_regionkey)) OVER (PARTITION BY substr(g1, 1, 2)) AS region_key
  FROM nation GROUP BY 1),
communes AS (SELECT p.*, r_name AS geo_region_nom FROM parents p LEFT JOIN region ON r_regionkey = region_key),
silver AS (
  SELECT {", ".join(FILLED)} FROM sales
  LEFT JOIN addresses ON adresse_numero = k1 AND adresse_nom_voie = k2 AND code_postal = k3 AND code_commune = k4
  LEFT JOIN energy ON ban_result_id = e1
  LEFT JOIN incomes ON nation = i1
  LEFT JOIN communes ON g1 = {PARENT.format(n="nation")})
"""


@query("silver_table", f"WITH {SALES} SELECT * FROM silver")
def silver_table(t):
    return sales_table(t).select(*FILLED)


@query(
    "project_addresses",
    f"""WITH {SALES} SELECT k1 AS adresse_numero, k2 AS adresse_nom_voie, k3 AS code_postal, k4 AS code_commune,
      ban_longitude, ban_latitude, ban_result_score, ban_result_label, ban_result_id, ban_result_city,
      ban_result_status FROM addresses""",
)
def project_addresses(t):
    typed = silver.type_addresses(raw_addresses(t))
    return typed.drop(*[f"ban_result_{c}" for c in ("housenumber", "street", "postcode", "citycode")])


@query(
    "project_energy",
    f"""WITH {SALES} SELECT e1 AS identifiant_ban, dpe_numero_dpe, dpe_etiquette_dpe, dpe_etiquette_ges,
      dpe_surface_habitable_logement, dpe_date_etablissement_dpe FROM energy""",
)
def project_energy(t):
    return silver.type_energy(raw_energy(t)).drop("dpe_type_batiment", "dpe_periode_construction")


@query(
    "project_incomes",
    f"""WITH {SALES} SELECT {_commune("i1")} AS code_commune, filosofi_nb_menages, filosofi_nb_personnes,
      filosofi_revenu_median, filosofi_gini_index, filosofi_s80_s20_ratio FROM incomes WHERE i1 < 10""",
)
def project_incomes(t):
    """Two departments of the commune table."""
    incomes = silver.type_incomes(raw_incomes(t), ["75", "69"])
    return incomes.drop("filosofi_interdecile_ratio", "filosofi_pct_revenu_social")


@query(
    "flatten_snapshot",
    f"""WITH {SALES} SELECT g1 AS code_commune_insee, geo_commune_nom, geo_commune_population, geo_epci_nom,
      geo_centre_longitude, geo_centre_latitude, geo_region_nom FROM communes""",
)
def flatten_snapshot(t):
    return silver.flatten_snapshot(raw_snapshot(t))


@query(
    "silver_partitions",
    f"""WITH {SALES} SELECT CAST(year(date_mutation) AS INTEGER) AS year, code_departement AS department,
      count(*) AS sales, count(ban_result_status) AS located, count(geo_commune_nom) AS placed
    FROM silver GROUP BY ALL""",
)
def silver_partitions(t):
    """All years and departments published by one job, then read back.

    Raw lines and staged sales are written tables, so that the shuffle files of
    one step are gone before those of the next are there.
    """
    path = scratch_path(t.spark, "published")
    with scratch_scope(t.spark):
        lines = materialize(raw_sales(t), "lines")
        staged = materialize(silver.build_silver(lines, lookups(t)), "silver")
        discard(lines)
        published = staged.withColumn("year", F.year("date_mutation")).withColumn("department", F.col("code_departement"))
        sinks.replace_partitions(published, path, ["year", "department"])
    return (
        t.spark.read.schema(published.schema)
        .parquet(path)
        .groupBy("year", "department")
        .agg(
            F.count(F.lit(1)).alias("sales"),
            F.count("ban_result_status").alias("located"),
            F.count("geo_commune_nom").alias("placed"),
        )
    )


def gold_sql(area: str, tables: str, table: str) -> str:
    return f"""WITH {tables},
    grain AS (
      SELECT id_mutation, code_commune, code_departement, date_mutation, max(valeur_fonciere) AS valeur_fonciere,
        sum(surface_reelle_bati) AS surface_reelle_bati
      FROM {table} WHERE nature_mutation = 'Vente' AND surface_reelle_bati > 0 AND valeur_fonciere > 0
      GROUP BY ALL),
    priced AS (
      SELECT *, valeur_fonciere / surface_reelle_bati AS price_per_sqm,
        concat(year(date_mutation), '-Q', quarter(date_mutation)) AS quarter FROM grain)
    SELECT {area}, quarter, count(*) AS nb_transactions,
      quantile_disc(price_per_sqm, 0.5) AS median_price_per_sqm,
      round(avg(price_per_sqm) + 1e-7, 4) AS avg_price_per_sqm,
      quantile_disc(valeur_fonciere, 0.5) AS median_valeur_fonciere,
      round(avg(valeur_fonciere) + 1e-7, 4) AS avg_valeur_fonciere,
      round(avg(surface_reelle_bati) + 1e-7, 4) AS avg_surface_reelle_bati
    FROM priced GROUP BY {area}, quarter"""


def _gold(area: str) -> str:
    return gold_sql(area, SALES, "silver")


@query("gold_price_by_commune_quarter", _gold("code_commune"))
def gold_price_by_commune_quarter(t):
    return shown_means(gold.price_by_commune(sales_table(t)))


@query("gold_price_by_department_quarter", _gold("code_departement"))
def gold_price_by_department_quarter(t):
    return shown_means(gold.price_by_department(sales_table(t)))


@query(
    "geocoding_input",
    f"""WITH {SALES}, texts AS (
      SELECT DISTINCT CAST(year(date_mutation) AS INTEGER) AS year, code_departement AS department,
        coalesce(CAST(adresse_numero AS VARCHAR), ' ') AS adresse_numero, adresse_nom_voie,
        code_postal, code_commune FROM sales WHERE adresse_nom_voie IS NOT NULL)
    SELECT row_number() OVER (PARTITION BY year, department
      ORDER BY adresse_numero, adresse_nom_voie, code_postal, code_commune) - 1 AS id, * FROM texts""",
)
def geocoding_input(t):
    """Each year and department has its own numbers."""
    scoped = raw_sales(t).withColumns(
        {"year": F.expr("year(to_date(date_mutation))"), "department": F.col("code_departement")}
    )
    return silver.geocoding_input(scoped, ["year", "department"])


@query(
    "report_price_trend",
    f"SELECT code_departement, quarter, median_price_per_sqm, avg_price_per_sqm FROM ({_gold('code_departement')})",
)
def report_price_trend(t):
    return shown_means(reports.price_trend(gold.price_by_department(sales_table(t)), "code_departement"))


@query(
    "report_transaction_volume",
    f"""SELECT code_departement, quarter, CAST(sum(nb_transactions) AS BIGINT) AS nb_transactions,
      grouping(code_departement) = 1 AS is_total FROM ({_gold('code_departement')})
    GROUP BY GROUPING SETS ((code_departement, quarter), (quarter))""",
)
def report_transaction_volume(t):
    return reports.transaction_volume(gold.price_by_department(sales_table(t)), "code_departement")


@query(
    "report_price_by_energy_label",
    f"""WITH {SALES} SELECT dpe_etiquette_dpe, count(*) AS nb_lines,
      quantile_disc(valeur_fonciere / surface_reelle_bati, 0.5) AS median_price_per_sqm,
      round(avg(valeur_fonciere / surface_reelle_bati) + 1e-7, 4) AS avg_price_per_sqm
    FROM silver WHERE nature_mutation = 'Vente' AND surface_reelle_bati > 0 AND valeur_fonciere > 0
    GROUP BY dpe_etiquette_dpe""",
)
def report_price_by_energy_label(t):
    return shown_means(reports.price_by_energy_label(sales_table(t)))


# The rules in the words of SQL, one counting expression each.
VIOLATIONS = {
    "1.1": "count(*) FILTER (WHERE valeur_fonciere IS NULL)",
    "1.2": """count(*) FILTER (WHERE type_local IN ('Appartement', 'Maison')
        AND (surface_reelle_bati IS NULL OR surface_reelle_bati <= 0))""",
    "2.1": """count(*) FILTER (WHERE nature_mutation NOT IN ('Vente', 'Echange',
        'Vente en l''état futur d''achèvement', 'Adjudication', 'Vente terrain à bâtir', 'Expropriation'))""",
    "2.2": """count(*) FILTER (WHERE type_local NOT IN ('Appartement', 'Maison', 'Dépendance',
        'Local industriel. commercial ou assimilé'))""",
    "2.3": "count(*) FILTER (WHERE NOT regexp_matches(code_postal, concat('^', code_departement, '[0-9]{3}$')))",
    "2.4": "count(*) FILTER (WHERE date_mutation < DATE '1998-01-01' OR date_mutation > DATE '1998-12-31')",
    "3.1": "count(*) FILTER (WHERE valeur_fonciere <= 0)",
    "3.2": "count(*) FILTER (WHERE valeur_fonciere < 1000)",
    "3.3": "count(*) FILTER (WHERE valeur_fonciere > 10000000)",
    "3.4": "count(*) FILTER (WHERE ban_result_score < 0.5)",
    "4.1": "count(*) - count(DISTINCT COLUMNS(*))",
}
BLOCKING = {"2.1", "2.2", "2.4", "3.1", "4.1"}
DESCRIPTIONS = {r.rule_id: r.description for r in m.all_rules("", "")[: len(VIOLATIONS)]}


def report_sql(group: str = "") -> str:
    """Oracle of the report over ``silver``, in total or per ``group``."""
    head = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    parts = []
    for rule_id, count in VIOLATIONS.items():
        severity = "HARD FAIL" if rule_id in BLOCKING else "WARNING"
        if rule_id == "4.1":
            count = "count(*) - count(DISTINCT silver)"
        passed = f"({count}) = 0" if rule_id in BLOCKING else "TRUE"
        parts.append(
            f"SELECT {head}'{rule_id}' AS rule_id, '{DESCRIPTIONS[rule_id]}' AS description, '{severity}' AS severity,"
            f" {count} AS violation_count, {passed} AS passed FROM silver {tail}"
        )
    for label, column, floor, severity in m.COVERAGE_FLOORS:
        met = f"count({column}) / count(*) >= {floor}"
        parts.append(
            f"SELECT {head}'5-{label}' AS rule_id,"
            f" printf('{column}: present in {floor * 100:.0f}%% or more of the rows, here in %.1f%%', count({column}) / count(*) * 100),"
            f" '{severity}', CASE WHEN {met} THEN 0 ELSE count(*) - count({column}) END,"
            f" {'TRUE' if severity == 'WARNING' else met} FROM silver {tail}"
        )
    return f"WITH {SALES} " + " UNION ALL ".join(parts)


RULES = m.all_rules("code_departement", "'1998'")


@query("quality_report", report_sql())
def quality_report(t):
    return quality.quality_report(materialize(sales_table(t), "sales"), RULES)


@query("quality_report_by_department", report_sql("code_departement"))
def quality_report_by_department(t):
    return quality.quality_report(materialize(sales_table(t), "sales"), RULES, by=["code_departement"])


@query("gate_failures", f"SELECT * FROM ({report_sql()}) WHERE severity = 'HARD FAIL' AND NOT passed")
def gate_failures(t):
    """What the gate would raise on."""
    return quality.blocking_failures(quality.quality_report(materialize(sales_table(t), "sales"), RULES))
