"""Fixed reference rows of the twenty districts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.functions.codes import code_of_district
from terrazzo.schemas import DIMENSION, DISTRICT_FIGURES, DISTRICT_QUARTERS


def _ordinal(n: int) -> str:
    return "1er" if n == 1 else f"{n}ème"


def population(spark: SparkSession) -> DataFrame:
    rows = [(n, people) for n, _, people, _ in DISTRICT_FIGURES]
    return spark.createDataFrame(rows, "arrondissement int, population_totale int")


def seed_dimension(spark: SparkSession) -> DataFrame:
    """The district dimension as first loaded; dwellings are filled in by a later update."""
    rows = [(n, f"Paris {_ordinal(n)} Arrondissement", area, people, density) for n, area, people, density in DISTRICT_FIGURES]
    df = spark.createDataFrame(
        rows, "arrondissement smallint, nom string, superficie_km2 double, population_2020 int, densite_population int"
    )
    return df.select(
        "arrondissement",
        code_of_district("arrondissement").alias("code_insee"),
        "nom",
        (F.col("arrondissement") + 75000).cast("string").alias("code_postal"),
        "superficie_km2",
        "population_2020",
        "densite_population",
        F.lit(None).cast("int").alias("nb_residences_principales"),
    ).to(DIMENSION)


def district_labels(spark: SparkSession) -> DataFrame:
    rows = [(n, f"{_ordinal(n)} arr. - {quarter}") for n, quarter in enumerate(DISTRICT_QUARTERS, start=1)]
    return spark.createDataFrame(rows, "arrondissement smallint, nom string")
