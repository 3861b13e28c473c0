"""The nested air quality delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.schemas import RAW_AIR
from terrazzo.sources.files import read_json_array


def read_air(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per delivered file. Under a declared schema `data` is a map, so a new code
    needs no new column."""
    return read_json_array(spark, path, RAW_AIR)


def air_rows(envelopes: DataFrame) -> DataFrame:
    """Deliveries to one row per code and forecast day."""
    return (
        envelopes.select(F.inline("arrondissements"))
        .select("insee", "arrondissement", "fetched_at", F.explode("data").alias("code", "readings"))
        .select("insee", "arrondissement", "fetched_at", "code", F.inline("readings"))
    )


def air_errors(envelopes: DataFrame) -> DataFrame:
    """Codes that could not be fetched."""
    return envelopes.select("date", F.inline("erreurs"))
