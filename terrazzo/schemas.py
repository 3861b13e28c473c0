"""Table schemas, column lists and fixed reference values."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(*fields: tuple) -> T.StructType:
    """Nullable fields from (name, type) pairs."""
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


def _strings(*names: str) -> T.StructType:
    return struct(*[(n, T.StringType()) for n in names])


_S, _I, _H, _D, _L = T.StringType(), T.IntegerType(), T.ShortType(), T.DoubleType(), T.LongType()

INGESTION_DATE = ("ingestion_year", "ingestion_month", "ingestion_day")
INGESTION_FIELDS = [T.StructField(c, T.StringType(), True) for c in INGESTION_DATE]

# ---- raw -------------------------------------------------------------------------------
RAW_SALES = _strings(
    "date_mutation", "nature_mutation", "valeur_fonciere", "code_commune", "type_local",
    "surface_reelle_bati", "nombre_pieces_principales",
)
RAW_RESIDENCES = _strings("CODGEO", "P22_RP")
RAW_HOUSING = struct(
    ("annee", _S), ("arrdt", T.LongType()), ("adresse_programme", _S), ("code_postal", _S),
    ("nb_logmt_total", T.LongType()), ("nb_plai", T.LongType()), ("nb_plus", T.LongType()),
    ("nb_pluscd", T.LongType()), ("nb_pls", T.LongType()), ("mode_real", _S), ("nature_programme", _S),
)
POLLUTANTS = ("no2", "o3", "pm10", "pm25", "so2")
AIR_READING = _strings("date", *POLLUTANTS, "indice")
RAW_AIR = struct(
    ("date", _S), ("nb_ok", _I), ("nb_erreurs", _I),
    ("arrondissements", T.ArrayType(struct(
        ("insee", _S), ("arrondissement", _I), ("fetched_at", _S),
        ("data", T.MapType(_S, T.ArrayType(AIR_READING))),
    ))),
    ("erreurs", T.ArrayType(_strings("insee", "error"))),
)

# fixed values: numeric columns of the income files, in their source order; a file may lack some
INCOME_COLUMNS = (
    "DEC_MED18", "DEC_Q118", "DEC_Q318", "DEC_GI18", "DEC_RD18",
    "DEC_D118", "DEC_D218", "DEC_D318", "DEC_D418", "DEC_D518",
    "DEC_D618", "DEC_D718", "DEC_D818", "DEC_D918",
    "DEC_PACT18", "DEC_PCHO18", "DEC_PPEN18",
)

# ---- silver ----------------------------------------------------------------------------
SILVER_SALES = struct(
    ("date_mutation", T.DateType()), ("annee", _I), ("arrondissement", _H), ("code_commune", _S),
    ("valeur_fonciere", _D), ("surface_reelle_bati", _D), ("nombre_pieces_principales", _I),
    ("type_local", _S), ("prix_m2", _D), ("nature_mutation", _S),
)
SILVER_CRIME = struct(
    ("annee", _H), ("arrondissement", _H), ("CODGEO_2025", _S), ("indicateur", _S),
    ("nombre", _D), ("taux_pour_mille", _D), ("unite_de_compte", _S), ("est_diffuse", _S),
)
SILVER_HOUSING = struct(
    ("annee", _H), ("arrondissement", _H), ("adresse_programme", _S), ("code_postal", _S),
    ("nb_logmt_total", _I), ("nb_plai", _I), ("nb_plus", _I), ("nb_pls", _I),
    ("mode_real", _S), ("nature_programme", _S),
)
SILVER_DISTRICTS = struct(
    ("arrondissement", _H), ("superficie_km2", _D), ("population_totale", _I), ("densite_population", _I),
)
SILVER_RESIDENCES = struct(("CODGEO", _S), ("arrondissement", _H), ("nb_residences_principales", _I))

SILVER_INCOMES = struct(("IRIS", _S), ("arrondissement", _H), *[(c, _D) for c in INCOME_COLUMNS])
SILVER = {
    "transactions": SILVER_SALES,
    "delinquance": SILVER_CRIME,
    "logements_sociaux": SILVER_HOUSING,
    "revenus": SILVER_INCOMES,
    "arrondissements": SILVER_DISTRICTS,
    "residences_principales": SILVER_RESIDENCES,
}

# ---- gold: fixed column names; counts and totals are wide enough for any number of rows ------------------------------------------------------------------------------
GOLD_KEY = ("arrondissement", "annee")
GOLD = struct(
    ("arrondissement", _H), ("annee", _H),
    ("nb_transactions", _L),
    ("prix_m2_median", T.DecimalType(18, 2)), ("prix_m2_moyen", T.DecimalType(18, 2)),
    ("prix_m2_q1", T.DecimalType(18, 2)), ("prix_m2_q3", T.DecimalType(18, 2)),
    ("surface_mediane", T.DecimalType(18, 2)), ("part_appartements", T.DecimalType(5, 2)),
    ("nb_logements_sociaux", _L), ("nb_plai", _L), ("nb_plus_pluscd", _L), ("nb_pls", _L),
    ("taux_logements_sociaux", T.DecimalType(18, 2)),
    ("taux_cambriolages_pmille", T.DecimalType(18, 3)), ("taux_violences_pmille", T.DecimalType(18, 3)),
    ("taux_delinquance_global", _L), ("taux_delinquance_pmille", T.DecimalType(18, 1)),
    ("revenu_median_arr", T.DecimalType(18, 2)), ("indice_gini_arr", T.DecimalType(6, 4)),
    ("rapport_interdecile_arr", T.DecimalType(6, 2)),
    ("part_studio_t1", T.DecimalType(5, 2)), ("part_t2", T.DecimalType(5, 2)),
    ("part_t3", T.DecimalType(5, 2)), ("part_t4", T.DecimalType(5, 2)), ("part_t5_plus", T.DecimalType(5, 2)),
    ("part_surf_lt20", T.DecimalType(5, 2)), ("part_surf_20_40", T.DecimalType(5, 2)),
    ("part_surf_40_60", T.DecimalType(5, 2)), ("part_surf_60_80", T.DecimalType(5, 2)),
    ("part_surf_80_120", T.DecimalType(5, 2)), ("part_surf_gt120", T.DecimalType(5, 2)),
    ("computed_at", T.TimestampType()),
)

DIMENSION = struct(
    ("arrondissement", _H), ("code_insee", _S), ("nom", _S), ("code_postal", _S),
    ("superficie_km2", _D), ("population_2020", _I), ("densite_population", _I),
    ("nb_residences_principales", _I),
)

RUN_STATUSES = ("running", "success", "failed", "skipped")
RUNS = struct(
    ("run_id", _S), ("pipeline_name", _S), ("source", _S), ("layer", _S), ("run_date", T.DateType()),
    ("started_at", T.TimestampType()), ("finished_at", T.TimestampType()), ("duration_s", _D),
    ("nb_lignes_in", T.LongType()), ("nb_lignes_out", T.LongType()), ("volume_mb", _D),
    ("statut", _S), ("erreur", _S), ("metadata", T.MapType(_S, _S)),
)

# ---- class boundaries ------------------------------------------------------------------
# fixed values: room classes in their reporting order, with the gold column that holds the share
ROOM_CLASSES = (
    ("studio_t1", "part_studio_t1"), ("t2", "part_t2"), ("t3", "part_t3"),
    ("t4", "part_t4"), ("t5_plus", "part_t5_plus"),
)
# fixed values: surface classes [low, high) in m2, with the gold column that holds the share
SURFACE_CLASSES = (
    ("lt_20", "part_surf_lt20", None, 20), ("bt_20_40", "part_surf_20_40", 20, 40),
    ("bt_40_60", "part_surf_40_60", 40, 60), ("bt_60_80", "part_surf_60_80", 60, 80),
    ("bt_80_120", "part_surf_80_120", 80, 120), ("gt_120", "part_surf_gt120", 120, None),
)
# price steps of the map legend
MAP_STEPS = (9000, 11000, 13000)

# ---- fixed values: the twenty districts -------------------------------------------------
# district, area in km2, inhabitants (2020 census), inhabitants per km2
DISTRICT_FIGURES = (
    (1, 1.825, 16266, 8912), (2, 0.992, 21559, 21733), (3, 1.171, 34576, 29527), (4, 1.601, 28088, 17544),
    (5, 2.541, 58850, 23161), (6, 2.153, 41100, 19090), (7, 4.088, 51765, 12661), (8, 3.881, 36808, 9484),
    (9, 2.178, 59895, 27500), (10, 2.893, 90372, 31238), (11, 3.667, 147476, 40219), (12, 6.383, 142327, 22296),
    (13, 7.146, 181556, 25406), (14, 5.621, 135964, 24188), (15, 8.502, 233484, 27462), (16, 7.913, 165820, 20955),
    (17, 5.669, 167476, 29543), (18, 6.005, 195233, 32511), (19, 6.786, 184389, 27170), (20, 5.983, 196004, 32762),
)
# quarter names used in the labels, district 1 first
DISTRICT_QUARTERS = (
    "Louvre", "Bourse", "Temple", "Hôtel-de-Ville", "Panthéon", "Luxembourg", "Palais-Bourbon", "Élysée",
    "Opéra", "Entrepôt", "Popincourt", "Reuilly", "Gobelins", "Observatoire", "Vaugirard", "Passy",
    "Batignolles", "Butte-Montmartre", "Buttes-Chaumont", "Ménilmontant",
)
