"""Bronze to silver: typed, filtered, keyed by district and year.

Each step reads its input once; malformed values become null (`rejects` counts them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.functions.air import worst_pollutants
from terrazzo.functions.codes import ZONE_PREFIX, district_of_code, district_of_zone, in_city, is_area_code
from terrazzo.functions.numbers import ratio, sum_of
from terrazzo.functions.parsing import decimals_to_double, iso_date, rejected, to_double, truncated, whole
from terrazzo.operators.filters import has_prefix, present
from terrazzo.schemas import INCOME_COLUMNS, POLLUTANTS
from terrazzo.sources.air import air_rows

MIN_SURFACE = 9
MIN_VALUE = 10_000
PRICE_RANGE = (500, 80_000)
HALF_CENT = 0.005


def sales(raw: DataFrame, kind: str | None = "Appartement") -> DataFrame:
    """Sales in the city with a plausible price per square metre; `kind` None keeps every type.

    The price range holds for the rounded price, both ends included. Half a cent more at either
    end is the same test on the quotient, without rounding in the filter.
    """
    low, high = PRICE_RANGE[0] - HALF_CENT, PRICE_RANGE[1] + HALF_CENT
    price = ratio(F.col("valeur_fonciere"), F.col("surface_reelle_bati"))
    kept = raw.filter(is_area_code("code_commune"))
    if kind is not None:
        kept = kept.filter(F.col("type_local") == kind)
    return (
        kept.withColumns(
            {
                "valeur_fonciere": to_double(raw, "valeur_fonciere"),
                "surface_reelle_bati": to_double(raw, "surface_reelle_bati"),
                "nombre_pieces_principales": whole("nombre_pieces_principales"),
                "date_mutation": iso_date(raw, "date_mutation"),
            }
        )
        .filter((F.col("surface_reelle_bati") > MIN_SURFACE) & (F.col("valeur_fonciere") > MIN_VALUE))
        .filter((price >= low) & (price < high))
        .withColumns(
            {
                "prix_m2": F.round(price, 2),
                "annee": F.year("date_mutation"),
                "arrondissement": district_of_code("code_commune"),
            }
        )
        .select(
            "date_mutation", "annee", "arrondissement", "code_commune", "valeur_fonciere", "surface_reelle_bati",
            "nombre_pieces_principales", "type_local", "prix_m2", "nature_mutation",
        )
    )


def sale_reject_counts(raw: DataFrame) -> dict[str, Column]:
    """Aggregates: malformed values per column of raw sales."""
    return {
        "bad_valeur_fonciere": rejected("valeur_fonciere", to_double(raw, "valeur_fonciere")),
        "bad_surface_reelle_bati": rejected("surface_reelle_bati", to_double(raw, "surface_reelle_bati")),
        "bad_nombre_pieces_principales": rejected("nombre_pieces_principales", whole("nombre_pieces_principales")),
        "bad_date_mutation": rejected("date_mutation", iso_date(raw, "date_mutation")),
    }


def sale_rejects(raw: DataFrame) -> DataFrame:
    """Malformed values per column of raw sales, in one pass."""
    return raw.agg(F.count("*").alias("n_rows"), *[count.alias(name) for name, count in sale_reject_counts(raw).items()])


def crime(raw: DataFrame) -> DataFrame:
    return raw.filter(is_area_code("CODGEO_2025")).select(
        whole("annee", "smallint").alias("annee"),
        district_of_code("CODGEO_2025").alias("arrondissement"),
        "CODGEO_2025",
        "indicateur",
        F.col("nombre").try_cast("double").alias("nombre"),
        F.col("taux_pour_mille").try_cast("double").alias("taux_pour_mille"),
        "unite_de_compte",
        "est_diffuse",
    )


def housing(raw: DataFrame) -> DataFrame:
    """Social housing programmes; two kinds of financing are added up."""
    return raw.select(
        whole("annee", "smallint").alias("annee"),
        whole("arrdt", "smallint").alias("arrondissement"),
        "adresse_programme",
        "code_postal",
        whole("nb_logmt_total").alias("nb_logmt_total"),
        whole("nb_plai").alias("nb_plai"),
        sum_of(whole("nb_plus"), whole("nb_pluscd")).alias("nb_plus"),
        whole("nb_pls").alias("nb_pls"),
        "mode_real",
        "nature_programme",
    ).filter(in_city("arrondissement"))


def incomes(raw: DataFrame) -> DataFrame:
    """Income zones of the city with the numeric columns that the file has."""
    columns = present(raw, list(INCOME_COLUMNS))
    return (
        decimals_to_double(raw.filter(has_prefix(F.col("IRIS"), ZONE_PREFIX)), columns)
        .select("IRIS", district_of_zone("IRIS").alias("arrondissement"), *columns)
        .filter(in_city("arrondissement"))
    )


def districts(raw: DataFrame) -> DataFrame:
    return (
        raw.select(
            whole("arrondissement", "smallint").alias("arrondissement"),
            F.col("superficie_km2").try_cast("double").alias("superficie_km2"),
            whole("population_totale").alias("population_totale"),
        )
        .filter(in_city("arrondissement"))
        .withColumn("densite_population", ratio(F.col("population_totale"), F.col("superficie_km2"), 0).try_cast("int"))
    )


def residences(raw: DataFrame) -> DataFrame:
    return raw.select(
        "CODGEO",
        district_of_code("CODGEO").alias("arrondissement"),
        truncated("P22_RP").alias("nb_residences_principales"),
    ).filter(in_city("arrondissement"))


def air(envelopes: DataFrame) -> DataFrame:
    """Air deliveries to one typed row per code and day, with the pollutants that set the index."""
    return air_rows(envelopes).select(
        "insee",
        F.col("arrondissement").cast("smallint").alias("arrondissement"),
        F.try_to_date("date", "yyyy-MM-dd").alias("date"),
        F.try_to_date("fetched_at", "yyyy-MM-dd").alias("fetched_at"),
        *POLLUTANTS,
        "indice",
        worst_pollutants({p: F.col(p) for p in POLLUTANTS}).alias("polluants_max"),
    )


# bronze source -> (silver table, step)
STEPS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "dvf": ("transactions", sales),
    "delinquance": ("delinquance", crime),
    "logements_sociaux": ("logements_sociaux", housing),
    "revenus": ("revenus", incomes),
    "arrondissements": ("arrondissements", districts),
    "residences_principales": ("residences_principales", residences),
    "airparif": ("airparif", air),
}

# the column of each silver table whose range its run logs
MEASURES = {
    "transactions": "prix_m2",
    "delinquance": "taux_pour_mille",
    "logements_sociaux": "nb_logmt_total",
    "revenus": "DEC_MED18",
    "arrondissements": "superficie_km2",
    "residences_principales": "nb_residences_principales",
}

# columns of a table whose distinct values are counted, about, by the pass that writes it
DISTINCT = {
    "transactions": ("code_commune", "annee"),
    "delinquance": ("indicateur", "annee"),
    "logements_sociaux": ("mode_real", "annee"),
}
