"""SQL twins of the shapes in `tables`, as common table expressions for DuckDB."""

from __future__ import annotations


def half_up(expression: str, digits: int) -> str:
    """Round half up on the decimal digits of a double, as Spark's `round` does."""
    return f"CAST(round(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def exact_sum(expression: str) -> str:
    """Sum of decimals of twelve places; a double goes through its text, so that both engines round the same digits."""
    return f"CAST(sum(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE)"


def exact_avg(expression: str) -> str:
    return f"({exact_sum(expression)} / nullif(CAST(count({expression}) AS DOUBLE), 0))"


def half_even(expression: str) -> str:
    return f"CAST(round_even({expression}, 0) AS BIGINT)"


def share(condition: str) -> str:
    return half_up(f"CAST(count(*) FILTER ({condition}) AS DOUBLE) / count(*) * 100", 2)


def code(district: str) -> str:
    return f"'751' || lpad(CAST({district} AS VARCHAR), 2, '0')"


RAW_SALES = f"""raw_sales AS (
  SELECT CAST(o_orderdate AS DATE) AS date_mutation, l_linestatus AS nature_mutation,
         l_extendedprice AS valeur_fonciere, {code('c_nationkey + 1')} AS code_commune,
         CASE WHEN l_returnflag = 'N' THEN 'Maison' ELSE 'Appartement' END AS type_local,
         l_quantity * 3 AS surface_reelle_bati, l_linenumber AS nombre_pieces_principales
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

PRICED = f"""priced AS (
  SELECT *, {half_up('valeur_fonciere / surface_reelle_bati', 2)} AS prix_m2,
         CAST(year(date_mutation) AS INTEGER) AS annee, CAST(CAST(code_commune AS INTEGER) - 75100 AS SMALLINT) AS arrondissement
  FROM raw_sales
  WHERE code_commune BETWEEN '75101' AND '75120' AND surface_reelle_bati > 9 AND valeur_fonciere > 10000),
all_sales AS (SELECT * FROM priced WHERE prix_m2 BETWEEN 500 AND 80000)"""

SALES = f"{RAW_SALES}, {PRICED}, sales AS (SELECT * FROM all_sales WHERE type_local = 'Appartement')"

CRIME = f"""crime AS (
  SELECT CAST(1995 + day(ts) % 7 AS SMALLINT) AS annee, CAST(user_id % 25 + 1 AS SMALLINT) AS arrondissement,
         {code('user_id % 25 + 1')} AS CODGEO_2025, event_type AS indicateur,
         CAST(event_id % 5 + 1 AS DOUBLE) AS nombre, value AS taux_pour_mille, 'fait' AS unite_de_compte,
         CASE WHEN value > 10 THEN 'diff' ELSE 'ndiff' END AS est_diffuse
  FROM events WHERE user_id % 25 + 1 BETWEEN 1 AND 20)"""

HOUSING = """housing AS (
  SELECT CAST(year(o_orderdate) AS SMALLINT) AS annee, CAST(c_nationkey + 1 AS SMALLINT) AS arrondissement,
         CAST(o_orderkey AS VARCHAR) AS adresse_programme, CAST(75001 + c_nationkey AS VARCHAR) AS code_postal,
         CAST(o_orderkey % 50 AS INTEGER) AS nb_logmt_total,
         CAST(CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey % 7 END AS INTEGER) AS nb_plai,
         CAST(coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 5 END, 0)
            + coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderkey % 3 END, 0) AS INTEGER) AS nb_plus,
         CAST(o_orderkey % 11 AS INTEGER) AS nb_pls, o_orderpriority AS mode_real, o_orderstatus AS nature_programme
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey < 20)"""

INCOMES = """incomes AS (
  SELECT '751' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS IRIS,
         CAST(c_nationkey + 1 AS SMALLINT) AS arrondissement,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS DEC_MED18,
         CAST('0.' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS DOUBLE) AS DEC_GI18,
         CAST(c_custkey % 9 + 0.5 AS DOUBLE) AS DEC_RD18
  FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey < 20)"""

DIM = f"""dim AS (
  SELECT CAST(n_nationkey + 1 AS SMALLINT) AS arrondissement, {code('n_nationkey + 1')} AS code_insee, n_name AS nom,
         CAST(75001 + n_nationkey AS VARCHAR) AS code_postal,
         {half_up('CAST(n_nationkey * 37 + 100 AS DOUBLE) / 64', 3)} AS superficie_km2,
         CAST(n_nationkey * 1300 + 16000 AS INTEGER) AS population_2020,
         CAST(n_nationkey * 911 % 7000 + 9000 AS INTEGER) AS densite_population,
         CAST(CASE WHEN n_nationkey % 6 = 0 THEN 0 ELSE n_nationkey * 700 + 9000 END AS INTEGER) AS nb_residences_principales
  FROM nation WHERE n_nationkey < 20)"""

ROOMS = {
    "part_studio_t1": "nombre_pieces_principales = 1", "part_t2": "nombre_pieces_principales = 2",
    "part_t3": "nombre_pieces_principales = 3", "part_t4": "nombre_pieces_principales = 4",
    "part_t5_plus": "nombre_pieces_principales >= 5",
}
SURFACES = {
    "part_surf_lt20": "surface_reelle_bati < 20",
    "part_surf_20_40": "surface_reelle_bati >= 20 AND surface_reelle_bati < 40",
    "part_surf_40_60": "surface_reelle_bati >= 40 AND surface_reelle_bati < 60",
    "part_surf_60_80": "surface_reelle_bati >= 60 AND surface_reelle_bati < 80",
    "part_surf_80_120": "surface_reelle_bati >= 80 AND surface_reelle_bati < 120",
    "part_surf_gt120": "surface_reelle_bati >= 120",
}
ROOM_SHARES = ", ".join(f"{share(c)} AS {n}" for n, c in ROOMS.items())
SURFACE_SHARES = ", ".join(f"{share(c)} AS {n}" for n, c in SURFACES.items())

G_SALES = f"""g_sales AS (
  SELECT arrondissement, annee, count(*) AS nb_transactions,
         quantile_disc(prix_m2, 0.5) AS prix_m2_median, {half_up(exact_avg('prix_m2'), 2)} AS prix_m2_moyen,
         quantile_disc(prix_m2, 0.25) AS prix_m2_q1, quantile_disc(prix_m2, 0.75) AS prix_m2_q3,
         quantile_disc(surface_reelle_bati, 0.5) AS surface_mediane, {ROOM_SHARES}, {SURFACE_SHARES},
         {half_up("nullif(count(*) FILTER (type_local = 'Appartement'), 0) / count(*) * 100", 2)} AS part_appartements
  FROM sales GROUP BY arrondissement, annee)"""

G_HOUSING = """g_housing AS (
  SELECT arrondissement, CAST(annee AS INTEGER) AS annee, CAST(sum(nb_logmt_total) AS BIGINT) AS nb_logements_sociaux,
         CAST(sum(nb_plai) AS BIGINT) AS nb_plai, CAST(sum(nb_plus) AS BIGINT) AS nb_plus_pluscd,
         CAST(sum(nb_pls) AS BIGINT) AS nb_pls
  FROM housing GROUP BY ALL)"""

_BURGLARY = "CASE WHEN contains(indicateur, 'purchase') THEN taux_pour_mille END"
_VIOLENT = "CASE WHEN contains(indicateur, 'error') OR contains(indicateur, 'sign') THEN taux_pour_mille END"
G_CRIME = f"""g_crime AS (
  SELECT arrondissement, CAST(annee AS INTEGER) AS annee, CAST(sum(nombre) AS BIGINT) AS taux_delinquance_global,
         {half_up(exact_sum('taux_pour_mille'), 1)} AS taux_delinquance_pmille,
         {exact_sum(_BURGLARY)} AS taux_cambriolages_pmille,
         {exact_sum(_VIOLENT)} AS taux_violences_pmille
  FROM crime GROUP BY arrondissement, annee)"""

G_INCOMES = f"""g_incomes AS (
  SELECT arrondissement, {half_up(exact_avg('DEC_MED18'), 2)} AS revenu_median_arr, {half_up(exact_avg('DEC_GI18'), 4)} AS indice_gini_arr,
         {half_up(exact_avg('DEC_RD18'), 2)} AS rapport_interdecile_arr
  FROM incomes GROUP BY arrondissement)"""

_PARTS = {
    "housing": (HOUSING, G_HOUSING, "LEFT JOIN g_housing USING (arrondissement, annee)"),
    "crime": (CRIME, G_CRIME, "LEFT JOIN g_crime USING (arrondissement, annee)"),
    "incomes": (INCOMES, G_INCOMES, "LEFT JOIN g_incomes USING (arrondissement)"),
}


def gold(*parts: str) -> str:
    """CTEs that end in `gold` with the named parts besides sales."""
    ctes = [SALES, G_SALES]
    joins = []
    for part in parts:
        source, grouped, join = _PARTS[part]
        ctes += [source, grouped]
        joins.append(join)
    ctes.append(f"gold AS (SELECT * FROM g_sales {' '.join(joins)})")
    return ", ".join(ctes)


def change(current: str, previous: str) -> str:
    return f"CASE WHEN {previous} > 0 THEN {half_up(f'({current} - {previous}) / {previous} * 100', 2)} END"
