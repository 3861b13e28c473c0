"""Raw deliveries to bronze: as delivered, restricted to the city where the delivery is wider."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.functions.codes import area_codes, in_city
from terrazzo.functions.numbers import km2
from terrazzo.functions.parsing import decimal_text, whole
from terrazzo.schemas import RAW_HOUSING
from terrazzo.sources.air import read_air
from terrazzo.sources.files import find_column, optional, read_csv, read_json_array, read_members, required, trimmed_header
from terrazzo.sources.reference import population

# fixed values: file names of the deliveries
SALES_FILES = "dvf_75_*.csv"
CRIME_FILE = "delinquance.parquet"
HOUSING_FILE = "logements_sociaux_raw.json"
INCOMES_FILE = "revenus_iris_paris.csv"
DISTRICTS_FILE = "arrondissements.csv"
AIR_FILE = "airparif_{date}.json"
RESIDENCES_FILE = "base-cc-logement-2022.CSV"


def sales(spark: SparkSession, folder: str, date: str) -> DataFrame:
    return required(lambda: read_csv(spark, f"{folder}/{SALES_FILES}"))


def crime(spark: SparkSession, folder: str, date: str) -> DataFrame:
    return required(lambda: read_members(spark, f"{folder}/{CRIME_FILE}", "CODGEO_2025", area_codes()))


def housing(spark: SparkSession, folder: str, date: str) -> DataFrame:
    return required(lambda: read_json_array(spark, f"{folder}/{HOUSING_FILE}", RAW_HOUSING))


def incomes(spark: SparkSession, folder: str, date: str) -> DataFrame:
    return required(lambda: trimmed_header(read_csv(spark, f"{folder}/{INCOMES_FILE}")))


def areas(raw: DataFrame, people: DataFrame) -> DataFrame:
    """District areas in km2 with their population; the number column is found by name."""
    number = find_column(raw, having="Num", lacking="INSEE")
    return (
        raw.select(whole(number).alias("arrondissement"), km2(decimal_text("Surface")).alias("superficie_km2"))
        .filter(in_city("arrondissement"))
        .join(people, "arrondissement")
        .select("arrondissement", "superficie_km2", "population_totale")
    )


def districts(spark: SparkSession, folder: str, date: str) -> DataFrame:
    raw = required(lambda: read_csv(spark, f"{folder}/{DISTRICTS_FILE}", sep=";"))
    return areas(raw, population(spark))


def air(spark: SparkSession, folder: str, date: str) -> DataFrame | None:
    """None on days without a delivery."""
    return optional(lambda: read_air(spark, f"{folder}/{AIR_FILE.format(date=date)}"))


def city_residences(raw: DataFrame) -> DataFrame:
    return raw.select("CODGEO", "P22_RP").filter(F.col("CODGEO").isin(area_codes()))


def residences(spark: SparkSession, folder: str, date: str) -> DataFrame:
    return city_residences(required(lambda: read_csv(spark, f"{folder}/{RESIDENCES_FILE}", sep=";")))


FEEDS: dict[str, Callable[[SparkSession, str, str], DataFrame | None]] = {
    "dvf": sales,
    "delinquance": crime,
    "logements_sociaux": housing,
    "revenus": incomes,
    "arrondissements": districts,
    "airparif": air,
    "residences_principales": residences,
}
