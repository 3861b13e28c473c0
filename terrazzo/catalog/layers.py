"""Silver and gold tables and the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrazzo.catalog import tables as t
from terrazzo.catalog.registry import query
from terrazzo.catalog.sqltext import (
    CRIME, DIM, G_CRIME, G_HOUSING, G_INCOMES, HOUSING, INCOMES, SALES, change, code, exact_avg, exact_sum, gold,
    half_even, half_up,
)
from terrazzo.operators.aggregates import (
    SALE_QUANTILES, crime_rates, distinct_error, distinct_figures, housing_totals, income_means, profile, sale_indicators,
)
from terrazzo.operators import sketches
from terrazzo.operators.upserts import latest_per_key
from terrazzo.plans import bronze, increments, reports, silver
from terrazzo.plans import gold as gold_plan
from terrazzo.schemas import DISTRICT_QUARTERS
from terrazzo.session import staged
from terrazzo.sources.reference import district_labels

_LABELS = f"list_value({', '.join(repr(q) for q in DISTRICT_QUARTERS)})"
YEAR = 1998
DISTRICT = 7
AIR_LABEL_SQL = "list_value('Bon', 'Moyen', 'Dégradé', 'Mauvais', 'Très mauvais', 'Extrêmement mauvais')"
_EVENTS = {"no2": "click", "o3": "error", "pm10": "purchase", "pm25": "signup", "so2": "view"}
AIR_COUNTS = "air_counts AS (SELECT CAST(user_id % 20 + 1 AS INTEGER) AS arrondissement, CAST(ts AS DATE) AS day, " + ", ".join(
    f"count(*) FILTER (event_type = '{e}') % 6 AS n_{p}" for p, e in _EVENTS.items()
) + " FROM events GROUP BY ALL)"


# a delivery holds the reading of its day and, where there is one, of the next
AIR_DELIVERED = f"""{AIR_COUNTS}, air_delivered AS (
  SELECT *, day AS fetched FROM air_counts
  UNION ALL SELECT b.*, a.day FROM air_counts a JOIN air_counts b ON a.arrondissement = b.arrondissement AND b.day = a.day + 1)"""


def text_dates(df: DataFrame) -> DataFrame:
    """Dates as text, so that both engines hand them over alike."""
    return df.withColumns({n: F.col(n).cast("string") for n, d in df.dtypes if d in ("date", "timestamp")})


# ---- silver ------------------------------------------------------------------------------


@query(
    "silver_sales",
    f"WITH {SALES} SELECT CAST(date_mutation AS VARCHAR) AS date_mutation, annee, arrondissement, code_commune, valeur_fonciere, "
    "surface_reelle_bati, nombre_pieces_principales, type_local, prix_m2, nature_mutation FROM sales",
)
def silver_sales(spark, sf):
    return text_dates(silver.sales(t.raw_sales(spark, sf, as_text=True)))


@query("silver_crime", f"WITH {CRIME} SELECT * FROM crime")
def silver_crime(spark, sf):
    return t.crime(spark, sf)


@query("silver_housing", f"WITH {HOUSING} SELECT * FROM housing")
def silver_housing(spark, sf):
    return t.housing(spark, sf)


@query("silver_incomes", f"WITH {INCOMES} SELECT * FROM incomes")
def silver_incomes(spark, sf):
    return t.incomes(spark, sf)


AREAS = f"""areas AS (
  SELECT CAST(c_nationkey + 1 AS INTEGER) AS arrondissement,
         {half_up("((count(*) + 100) * 12345 + 0.5::DOUBLE) / 1000000", 3)} AS superficie_km2,
         CAST(count(*) * 40 AS INTEGER) AS population_totale
  FROM customer WHERE c_nationkey < 20 GROUP BY c_nationkey)"""


@query(
    "silver_districts",
    f"WITH {AREAS} SELECT CAST(arrondissement AS SMALLINT) AS arrondissement, superficie_km2, population_totale, "
    f"CAST({half_up('population_totale / superficie_km2', 0)} AS INTEGER) AS densite_population FROM areas",
)
def silver_districts(spark, sf):
    return silver.districts(bronze.areas(t.raw_areas(spark, sf), t.people(spark, sf)))


RESIDENCES = f"""residences AS (
  SELECT {code('s_nationkey + 1')} AS CODGEO, CAST(s_nationkey + 1 AS SMALLINT) AS arrondissement,
         CAST(count(*) * 1000 AS INTEGER) AS nb_residences_principales
  FROM supplier WHERE s_nationkey < 20 GROUP BY s_nationkey)"""


@query("silver_residences", f"WITH {RESIDENCES} SELECT * FROM residences")
def silver_residences(spark, sf):
    return silver.residences(bronze.city_residences(t.raw_residences(spark, sf)))


_WORST = "greatest(" + ", ".join(f"n_{p}" for p in _EVENTS) + ")"
_NAMES = " || ".join(f"CASE WHEN n_{p} = {_WORST} THEN ',{p}' ELSE '' END" for p in _EVENTS)


@query(
    "silver_air",
    f"WITH {AIR_DELIVERED} SELECT {code('arrondissement')} AS insee, CAST(arrondissement AS SMALLINT) AS arrondissement, "
    'CAST(day AS VARCHAR) AS "date", CAST(fetched AS VARCHAR) AS fetched_at, '
    + ", ".join(f"{AIR_LABEL_SQL}[n_{p} + 1] AS {p}" for p in _EVENTS)
    + f", {AIR_LABEL_SQL}[n_no2 + 1] AS indice, substr({_NAMES}, 2) AS polluants_max FROM air_delivered",
)
def silver_air(spark, sf):
    return text_dates(silver.air(t.air_envelopes(spark, sf)))


@query(
    "sale_quality",
    f"WITH {SALES} SELECT count(*) AS n_rows, min(prix_m2) AS prix_m2_min, max(prix_m2) AS prix_m2_max, "
    f"{half_up('avg(prix_m2)', 4)} AS prix_m2_avg, count(DISTINCT annee) AS annee_distinct FROM sales",
)
def sale_quality(spark, sf):
    return profile(t.sales(spark, sf), "prix_m2", distinct=["annee"]).withColumn("prix_m2_avg", F.round("prix_m2_avg", 4))


@query(
    "distinct_sketched",
    "SELECT count(*) AS n_rows, count(DISTINCT o_orderstatus) AS o_orderstatus_distinct, count(DISTINCT o_orderpriority) AS o_orderpriority_distinct, "
    "true AS within FROM orders",
)
def distinct_sketched(spark, sf):
    """Few distinct values are counted exactly, many within five standard errors."""
    orders = t.table(spark, sf, "orders")
    figures = distinct_figures("o_orderstatus", "o_orderpriority", "o_orderkey", "o_custkey")
    told = orders.agg(F.count("*").alias("n_rows"), *[c.alias(name) for name, c in figures.items()])
    exact = orders.agg(F.count_distinct("o_orderkey").alias("orders"), F.count_distinct("o_custkey").alias("customers"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 5 * distinct_error() * F.col(b)
    within = near("o_orderkey_distinct", "orders") & near("o_custkey_distinct", "customers")
    # one row beside one row
    both = told.withColumn("_one", F.lit(1)).join(exact.withColumn("_one", F.lit(1)), "_one")
    return both.select("n_rows", "o_orderstatus_distinct", "o_orderpriority_distinct", within.alias("within"))


# ---- gold --------------------------------------------------------------------------------


@query("gold_fact", f"WITH {gold('housing', 'crime', 'incomes')} SELECT * FROM gold")
def gold_fact(spark, sf):
    return t.gold(spark, sf, "housing", "crime", "incomes")


@query("gold_refreshed", f"WITH {gold('housing', 'crime', 'incomes')} SELECT * FROM gold")
def gold_refreshed(spark, sf):
    """The gold of an earlier ingestion, without the newest year of sales, brought up to date: equal to a full build of all rows."""
    sources = {"sales": t.sales(spark, sf), "housing": t.housing(spark, sf), "crime": t.crime(spark, sf), "incomes": t.incomes(spark, sf)}
    options = {"burglary": t.BURGLARY, "violence": t.VIOLENCE}
    earlier = {**sources, "sales": sources["sales"].where(F.col("annee") < YEAR)}
    stored = staged(gold_plan.gold(**earlier, **options), "gold")
    touched = increments.touched_groups(increments.silver_prints(**earlier), increments.silver_prints(**sources))
    return increments.refreshed_gold(stored, touched, **sources, **options)


@query("gold_sales", f"WITH {gold()} SELECT * FROM gold")
def gold_sales(spark, sf):
    return t.gold(spark, sf)


@query(
    "gold_sales_sketched",
    f"WITH {SALES} SELECT arrondissement, annee, n, unnest([{', '.join(map(repr, SALE_QUANTILES))}]) AS name, true AS within_bound "
    "FROM (SELECT arrondissement, annee, count(*) AS n FROM sales GROUP BY ALL)",
)
def gold_sales_sketched(spark, sf):
    """Sketched quantiles, each with a check that its rank is off by at most n / accuracy."""
    accuracy, keys = 1000, ["arrondissement", "annee"]
    sales = t.sales(spark, sf)
    sketch = sale_indicators(sales, accuracy=accuracy).select(*keys, *SALE_QUANTILES)
    # counts of each value meet the sketches, not the sales
    columns = list(dict.fromkeys(column for column, _ in SALE_QUANTILES.values()))
    values = sales.unpivot(keys, [F.col(c).cast("double").alias(c) for c in columns], "measure", "value")
    counted = values.groupBy(*keys, "measure", "value").agg(F.count("*").alias("k")).join(sketch, keys)
    measures = {"n": F.sum(F.when(F.col("measure") == columns[0], F.col("k")))}
    for name, (column, _) in SALE_QUANTILES.items():
        own = F.col("measure") == column
        measures[f"{name}_below"] = F.sum(F.when(own & (F.col("value") < F.col(name)), F.col("k")).otherwise(0))
        measures[f"{name}_upto"] = F.sum(F.when(own & (F.col("value") <= F.col(name)), F.col("k")).otherwise(0))
    ranks = counted.groupBy(*keys).agg(*[m.alias(k) for k, m in measures.items()])

    def ok(name: str):
        wanted, slack = F.col("n") * SALE_QUANTILES[name][1], F.ceil(F.col("n") / accuracy)
        return (F.col(f"{name}_upto") >= wanted - slack) & (F.col(f"{name}_below") <= wanted + slack)

    flags = ranks.select("arrondissement", "annee", "n", *[ok(name).alias(name) for name in SALE_QUANTILES])
    return flags.unpivot(["arrondissement", "annee", "n"], list(SALE_QUANTILES), "name", "within_bound")


@query("gold_housing", f"WITH {HOUSING}, {G_HOUSING} SELECT * REPLACE (CAST(annee AS SMALLINT) AS annee) FROM g_housing")
def gold_housing(spark, sf):
    return housing_totals(t.housing(spark, sf))


@query("gold_crime", f"WITH {CRIME}, {G_CRIME} SELECT * REPLACE (CAST(annee AS SMALLINT) AS annee) FROM g_crime")
def gold_crime(spark, sf):
    return crime_rates(t.crime(spark, sf), burglary=t.BURGLARY, violence=t.VIOLENCE)


@query("gold_incomes", f"WITH {INCOMES}, {G_INCOMES} SELECT * FROM g_incomes")
def gold_incomes(spark, sf):
    return income_means(t.incomes(spark, sf))


@query(
    "dimension_refreshed",
    f"WITH {DIM}, {AREAS}, {RESIDENCES} SELECT d.arrondissement, code_insee, nom, code_postal, "
    "coalesce(a.superficie_km2, d.superficie_km2) AS superficie_km2, coalesce(population_totale, population_2020) AS population_2020, "
    f"coalesce(CAST({half_up('a.population_totale / a.superficie_km2', 0)} AS INTEGER), densite_population) AS densite_population, "
    "coalesce(r.nb_residences_principales, d.nb_residences_principales) AS nb_residences_principales "
    "FROM dim d LEFT JOIN areas a USING (arrondissement) LEFT JOIN residences r USING (arrondissement)",
)
def dimension_refreshed(spark, sf):
    areas = silver.districts(bronze.areas(t.raw_areas(spark, sf), t.people(spark, sf)))
    residences = silver.residences(bronze.city_residences(t.raw_residences(spark, sf)))
    with_areas = gold_plan.dimension_with_areas(t.dimension(spark, sf), areas)
    return gold_plan.dimension_with_residences(with_areas, residences)


# ---- reports -----------------------------------------------------------------------------

_KPI = f"""{gold('housing', 'crime', 'incomes')}, {DIM},
cumul AS (SELECT arrondissement, sum(coalesce(nb_logements_sociaux, 0)) AS social FROM gold WHERE annee <= {YEAR} GROUP BY 1),
prev AS (SELECT arrondissement, prix_m2_median AS prev FROM gold WHERE annee = {YEAR - 1}),
kpi AS (
  SELECT g.arrondissement, g.annee AS year, nom, prix_m2_median, nb_transactions AS transactions_total,
         revenu_median_arr AS revenu_median, taux_delinquance_global, taux_delinquance_pmille, densite_population,
         CASE WHEN nb_residences_principales > 0
              THEN {half_up('coalesce(social, 0) * 100.0::DOUBLE / nb_residences_principales', 1)} ELSE 0.0::DOUBLE END AS tx_logement_sociaux,
         {change('prix_m2_median', 'prev')} AS variation
  FROM gold g JOIN dim USING (arrondissement) LEFT JOIN cumul USING (arrondissement) LEFT JOIN prev USING (arrondissement)
  WHERE g.annee = {YEAR})"""

_WEIGHT = "coalesce(nullif(transactions_total, 0), 1)"


def _weighted(value: str) -> str:
    weights = f"CASE WHEN {value} IS NOT NULL THEN {_WEIGHT} END"
    return half_up(f"{exact_sum(f'{value} * {_WEIGHT}')} / CAST(sum({weights}) AS DOUBLE)", 2)


@query("report_kpi", f"WITH {_KPI} SELECT * FROM kpi")
def report_kpi(spark, sf):
    return reports.kpi(t.stored_gold(spark, sf), t.dimension(spark, sf), YEAR)


@query("report_kpi_district", f"WITH {_KPI} SELECT * FROM kpi WHERE arrondissement = {DISTRICT}")
def report_kpi_district(spark, sf):
    fact = t.stored_gold(spark, sf)
    return reports.kpi(fact, t.dimension(spark, sf), YEAR, district=f"751{DISTRICT:02d}")




def air_documents(spark, sf) -> DataFrame:
    """The latest reading of each code as a live document."""
    readings = silver.air(t.air_envelopes(spark, sf)).select("insee", "date", "indice")
    return latest_per_key(readings, "insee", ["date"]).select(
        "insee", F.to_json(F.struct(F.array(F.struct("date", "indice")).alias("data"))).alias("document")
    )


_LAST_AIR = "last AS (SELECT arrondissement, arg_max(n_no2, day) AS n FROM air_counts GROUP BY 1)"


@query(
    "report_kpi_with_air",
    f"WITH {_KPI}, {AIR_COUNTS}, {_LAST_AIR} "
    "SELECT * EXCLUDE (nom, n), CASE WHEN arrondissement <= 10 THEN nom END AS nom, CASE WHEN arrondissement <= 10 THEN nom ELSE "
    f"arrondissement || 'ème arr. - ' || {_LABELS}[arrondissement] END AS label, {AIR_LABEL_SQL}[n + 1] AS air_quality_global "
    "FROM kpi LEFT JOIN last USING (arrondissement)",
)
def report_kpi_with_air(spark, sf):
    """The later districts have no name and get the fixed label."""
    fact = t.stored_gold(spark, sf)
    dim = t.dimension(spark, sf).withColumn("nom", F.when(F.col("arrondissement") <= 10, F.col("nom")))
    rows = reports.kpi(fact, dim, YEAR)
    return reports.kpi_with_air(rows, district_labels(spark), reports.air_labels(air_documents(spark, sf)))


_KPI_CITY = f"""{_KPI}, city AS (SELECT year, {_weighted('prix_m2_median')} AS prix_m2_median, {_weighted('variation')} AS variation,
    {half_up(exact_avg('densite_population'), 2)} AS densite_population,
    {half_up(exact_avg('tx_logement_sociaux'), 2)} AS tx_logement_sociaux, {_weighted('revenu_median')} AS revenu_median,
    coalesce(nullif(CAST(sum(transactions_total) AS BIGINT), 0), count(*)) AS transactions_total,
    {half_up(exact_avg('taux_delinquance_global'), 2)} AS taux_delinquance_global,
    {half_up(exact_avg('taux_delinquance_pmille'), 2)} AS taux_delinquance_pmille,
    0 AS arrondissement, 'Paris (tous arrondissements)' AS nom, 'Paris (tous arrondissements)' AS label FROM kpi GROUP BY year)"""


def _kpi_city(spark, sf) -> DataFrame:
    fact = t.stored_gold(spark, sf)
    return reports.kpi_city(reports.kpi(fact, t.dimension(spark, sf), YEAR))


@query("report_kpi_city", f"WITH {_KPI_CITY} SELECT * FROM city")
def report_kpi_city(spark, sf):
    return _kpi_city(spark, sf)


@query(
    "report_kpi_sets",
    f"WITH {_KPI_CITY} SELECT CAST(arrondissement AS INTEGER) AS arrondissement, year, nom, transactions_total, prix_m2_median, variation, revenu_median, "
    "CAST(densite_population AS DOUBLE) AS densite_population, tx_logement_sociaux, CAST(taux_delinquance_global AS DOUBLE) AS taux_delinquance_global, "
    "taux_delinquance_pmille FROM kpi UNION ALL SELECT arrondissement, year, nom, transactions_total, prix_m2_median, variation, revenu_median, "
    "densite_population, tx_logement_sociaux, taux_delinquance_global, taux_delinquance_pmille FROM city",
)
def report_kpi_sets(spark, sf):
    """Districts and city from one aggregate."""
    return reports.kpi_sets(t.stored_gold(spark, sf), t.dimension(spark, sf), YEAR)


@query(
    "gold_sketches",
    f"WITH {SALES} SELECT annee, count(prix_m2) AS n, true AS within FROM sales GROUP BY 1 "
    "UNION ALL SELECT 0, count(prix_m2), true FROM sales",
)
def gold_sketches(spark, sf):
    """Stored sketches merged to each year and to all years: the sketched quartiles are where the exact ranks say, within the bound."""
    sales = t.sales(spark, sf)
    stored = staged(sketches.sketched(sales), "sketches")
    every = F.explode(F.array("annee", F.lit(0))).alias("annee")
    shares = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    merged = sketches.merged(stored.select(every, "prix_m2_sketch", "surface_reelle_bati_sketch"), ("annee",))
    quantiles = merged.select("annee", sketches.rows_of("prix_m2").alias("n"), *[sketches.quantile("prix_m2", x).alias(q) for q, x in shares.items()])
    ranked = sales.select(every, "prix_m2").join(quantiles, "annee").groupBy("annee", "n")
    ranks = ranked.agg(
        *[F.count_if(F.col("prix_m2") < F.col(q)).alias(f"{q}_low") for q in shares],
        *[F.count_if(F.col("prix_m2") <= F.col(q)).alias(f"{q}_high") for q in shares],
    )
    within = F.lit(True)
    for q, share in shares.items():
        # twice the error of 99 in 100 cases, and one row for the rounding of ranks
        slack = 2 * sketches.rank_error() * F.col("n") + 1
        within = within & (F.col(f"{q}_low") <= share * F.col("n") + slack) & (F.col(f"{q}_high") >= share * F.col("n") - slack)
    return ranks.select(F.col("annee").cast("int").alias("annee"), "n", within.alias("within"))


@query(
    "report_kpi_city_with_air",
    f"WITH {_KPI_CITY}, {AIR_COUNTS}, {_LAST_AIR} SELECT city.*, "
    f"(SELECT {AIR_LABEL_SQL}[n + 1] FROM last WHERE arrondissement > 6 ORDER BY arrondissement LIMIT 1) AS air_quality_global FROM city",
)
def report_kpi_city_with_air(spark, sf):
    """The first six codes have no label."""
    return reports.kpi_city_with_air(_kpi_city(spark, sf), _late_labels(reports.air_labels(air_documents(spark, sf))))


def _late_labels(labels: DataFrame) -> DataFrame:
    return labels.withColumn("air_label", F.when(F.col("insee") > "75106", F.col("air_label")))


def _split_sql(names: dict[str, str], where: str) -> str:
    parts = [
        f"SELECT '{name}' AS id, value, {half_even('value / 100 * total')} AS count, CAST(trunc(total) AS BIGINT) AS total FROM "
        f"(SELECT {exact_avg(column)} AS value, avg(nb_transactions) AS total FROM gold WHERE {where}) WHERE value IS NOT NULL"
        for name, column in names.items()
    ]
    return f"WITH {gold()} " + " UNION ALL ".join(parts)


_ROOM_IDS = {"studio_t1": "part_studio_t1", "t2": "part_t2", "t3": "part_t3", "t4": "part_t4", "t5_plus": "part_t5_plus"}
_SURFACE_IDS = {
    "lt_20": "part_surf_lt20", "bt_20_40": "part_surf_20_40", "bt_40_60": "part_surf_40_60",
    "bt_60_80": "part_surf_60_80", "bt_80_120": "part_surf_80_120", "gt_120": "part_surf_gt120",
}


@query("report_typology", _split_sql(_ROOM_IDS, f"annee = {YEAR}"))
def report_typology(spark, sf):
    return reports.typology(t.stored_gold(spark, sf), YEAR)


@query("report_typology_district", _split_sql(_ROOM_IDS, f"annee = {YEAR} AND arrondissement = {DISTRICT}"))
def report_typology_district(spark, sf):
    return reports.typology(t.stored_gold(spark, sf), YEAR, DISTRICT)


@query("report_surfaces", _split_sql(_SURFACE_IDS, f"annee = {YEAR}"))
def report_surfaces(spark, sf):
    return reports.surfaces(t.stored_gold(spark, sf), YEAR)


HISTORY = (
    f"WITH {gold()} SELECT annee AS year, "
    f"{half_up(exact_sum('prix_m2_median * coalesce(nb_transactions, 1)') + ' / CAST(sum(coalesce(nb_transactions, 1)) AS DOUBLE)', 0)}"
    " AS median_price_per_sqm FROM gold WHERE prix_m2_median IS NOT NULL GROUP BY annee"
)


@query("report_price_history", HISTORY)
def report_price_history(spark, sf):
    return reports.price_history(t.stored_gold(spark, sf))


@query(
    "report_price_history_district",
    f"WITH {gold()} SELECT annee AS year, prix_m2_median AS median_price_per_sqm FROM gold WHERE arrondissement = {DISTRICT}",
)
def report_price_history_district(spark, sf):
    return reports.price_history(t.stored_gold(spark, sf), str(DISTRICT))


_STEP = "CAST(CASE WHEN prix_m2_median >= 13000 THEN 3 WHEN prix_m2_median >= 11000 THEN 2 WHEN prix_m2_median >= 9000 THEN 1 ELSE 0 END AS INTEGER)"


@query(
    "report_map_prices",
    f"WITH {gold()} SELECT {code('arrondissement')} AS code, prix_m2_median AS price, {_STEP} AS step FROM gold WHERE annee = {YEAR}",
)
def report_map_prices(spark, sf):
    return reports.map_prices(t.stored_gold(spark, sf), YEAR)


@query(
    "report_data_table",
    f"""WITH {gold('housing', 'incomes')}, {DIM},
    cumul AS (SELECT arrondissement, sum(coalesce(nb_logements_sociaux, 0)) AS social FROM gold GROUP BY 1),
    prev AS (SELECT arrondissement, prix_m2_median AS prev FROM gold WHERE annee = {YEAR - 1})
    SELECT g.arrondissement, CASE WHEN g.arrondissement <= 10 THEN nom ELSE g.arrondissement || 'ème arr. - ' || {_LABELS}[g.arrondissement] END AS nom,
    prix_m2_median, {change('prix_m2_median', 'prev')} AS variation, nb_transactions,
    CASE WHEN population_2020 > 0
         THEN {half_up('coalesce(social, 0) * 100.0::DOUBLE / (population_2020 / 2.2::DOUBLE)', 1)} ELSE 0.0::DOUBLE END AS tx_logement_sociaux,
    revenu_median_arr, densite_population
    FROM gold g JOIN dim USING (arrondissement) LEFT JOIN cumul USING (arrondissement) LEFT JOIN prev USING (arrondissement)
    WHERE g.annee = {YEAR}""",
)
def report_data_table(spark, sf):
    """The later districts have no name and get the default label."""
    dim = t.dimension(spark, sf).withColumn("nom", F.when(F.col("arrondissement") <= 10, F.col("nom")))
    return reports.data_table(t.stored_gold(spark, sf), dim, YEAR)


@query(
    "report_district_list",
    f"WITH {DIM}, {AREAS} SELECT arrondissement, code_insee, nom, code_postal, "
    "coalesce(a.superficie_km2, dim.superficie_km2) AS superficie_km2, coalesce(population_totale, population_2020) AS population_2020 "
    "FROM dim LEFT JOIN areas a USING (arrondissement)",
)
def report_district_list(spark, sf):
    areas = silver.districts(bronze.areas(t.raw_areas(spark, sf), t.people(spark, sf)))
    return reports.district_list(gold_plan.dimension_with_areas(t.dimension(spark, sf), areas))


@query(
    "report_transactions",
    f"WITH {gold()} SELECT arrondissement, annee, nb_transactions, prix_m2_median, prix_m2_moyen, prix_m2_q1, prix_m2_q3, "
    f"surface_mediane, part_appartements FROM gold WHERE arrondissement = {DISTRICT} AND annee = {YEAR}",
)
def report_transactions(spark, sf):
    return reports.transactions(t.stored_gold(spark, sf), DISTRICT, YEAR)


@query(
    "report_social_housing",
    f"WITH {gold('housing')} SELECT arrondissement, annee, nb_logements_sociaux, nb_plai, nb_plus_pluscd, nb_pls FROM gold "
    f"WHERE annee = {YEAR}",
)
def report_social_housing(spark, sf):
    return reports.social_housing(t.stored_gold(spark, sf), year=YEAR)


@query(
    "report_crime",
    f"WITH {gold('crime')} SELECT arrondissement, annee, taux_cambriolages_pmille, taux_violences_pmille, taux_delinquance_global FROM gold",
)
def report_crime(spark, sf):
    return reports.crime(t.stored_gold(spark, sf))


@query(
    "report_incomes",
    f"WITH {gold('incomes')} SELECT DISTINCT arrondissement, revenu_median_arr, indice_gini_arr, rapport_interdecile_arr FROM gold",
)
def report_incomes(spark, sf):
    return reports.incomes(t.stored_gold(spark, sf))


@query(
    "report_composite",
    f"WITH {gold('housing', 'crime', 'incomes')}, {DIM} SELECT gold.*, nom, code_postal, superficie_km2 "
    "FROM gold JOIN dim USING (arrondissement)",
)
def report_composite(spark, sf):
    return reports.composite(t.stored_gold(spark, sf), t.dimension(spark, sf))


@query(
    "report_live_air",
    f"WITH {AIR_COUNTS} SELECT {code('arrondissement')} AS insee, CAST(max(day) AS VARCHAR) AS \"date\", "
    f"{AIR_LABEL_SQL}[arg_max(n_no2, day) + 1] AS indice FROM air_counts WHERE arrondissement = {DISTRICT} GROUP BY arrondissement",
)
def report_live_air(spark, sf):
    readings = silver.air(t.air_envelopes(spark, sf)).select("insee", "date", "indice")
    return text_dates(reports.live_air(latest_per_key(readings, "insee", ["date"]), DISTRICT))


@query(
    "report_city_air_label",
    f"WITH {AIR_COUNTS}, last AS (SELECT arrondissement, arg_max(n_no2, day) AS n FROM air_counts GROUP BY 1) "
    f"SELECT {code('arrondissement')} AS insee, {AIR_LABEL_SQL}[n + 1] AS air_label FROM last WHERE arrondissement > 6 ORDER BY arrondissement LIMIT 1",
)
def report_city_air_label(spark, sf):
    """The first six codes have no label."""
    readings = silver.air(t.air_envelopes(spark, sf)).select("insee", "date", "indice")
    documents = latest_per_key(readings, "insee", ["date"]).select(
        "insee", F.to_json(F.struct(F.create_map("insee", F.array(F.struct("indice"))).alias("data"))).alias("document")
    )
    return reports.city_air_label(_late_labels(reports.air_labels(documents)))
