"""Silver to gold: one row per district and year with sales."""

from __future__ import annotations

from pyspark.sql import DataFrame

from terrazzo.operators.aggregates import SALE_QUANTILES, crime_rates, housing_totals, income_means, sale_indicators
from terrazzo.operators.upserts import update_matched


def gold(
    sales: DataFrame,
    housing: DataFrame | None = None,
    crime: DataFrame | None = None,
    incomes: DataFrame | None = None,
    accuracy: int | None = None,
    quantiles: dict[str, tuple[str, float]] = SALE_QUANTILES,
    **crime_options,
) -> DataFrame:
    """Indicators of the four silver sources, left-joined to the sales groups.

    Every source is aggregated before it is joined, so the joins see one row per group. Sources
    and quantiles that a report does not need can be left out.
    """
    fact = sale_indicators(sales, accuracy=accuracy, quantiles=quantiles)
    if housing is not None:
        fact = fact.join(housing_totals(housing), ["arrondissement", "annee"], "left")
    if crime is not None:
        fact = fact.join(crime_rates(crime, **crime_options), ["arrondissement", "annee"], "left")
    if incomes is not None:
        fact = fact.join(income_means(incomes), ["arrondissement"], "left")
    return fact


def dimension_with_areas(dimension: DataFrame, districts: DataFrame) -> DataFrame:
    """Area, population and density of known districts from silver."""
    return update_matched(
        dimension,
        districts,
        "arrondissement",
        {
            "superficie_km2": "superficie_km2",
            "population_2020": "population_totale",
            "densite_population": "densite_population",
        },
    )


def dimension_with_residences(dimension: DataFrame, residences: DataFrame) -> DataFrame:
    """Number of main residences of known districts from silver."""
    return update_matched(
        dimension, residences, "arrondissement", {"nb_residences_principales": "nb_residences_principales"}
    )
