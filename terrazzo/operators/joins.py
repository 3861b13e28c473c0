"""Joins between facts, dimension and earlier years.

No broadcast is forced anywhere: dimension and gold tables are far below Spark's broadcast
threshold and are broadcast by it, and a larger table falls back to a sort-merge join, where
adaptive execution splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_dimension(fact: DataFrame, dimension: DataFrame, columns: list[str], key: str = "arrondissement") -> DataFrame:
    """Inner join of a fact with some columns of the district dimension."""
    return fact.join(dimension.select(key, *columns), key)


def with_label(
    df: DataFrame, labels: DataFrame, key: str = "arrondissement", name: str = "nom", default: str = "Arr. "
) -> DataFrame:
    """Attach a label, or the default followed by the key where there is none."""
    text = F.coalesce(F.col(name), F.concat(F.lit(default), F.col(key).cast("string")))
    return df.join(labels.select(key, name), key, "left").withColumn(name, text)


def with_previous_year(fact: DataFrame, value: str, key: str = "arrondissement", year: str = "annee") -> DataFrame:
    """Left self-join with the year before, as `prev_<value>`.

    For facts whose keys are unique; `windows.previous_year` gives the same without reading
    the fact twice.
    """
    earlier = fact.select(key, (F.col(year) + 1).alias(year), F.col(value).alias(f"prev_{value}"))
    return fact.join(earlier, [key, year], "left")


def with_total_until(fact: DataFrame, value: str, until: int, key: str = "arrondissement", year: str = "annee") -> DataFrame:
    """Left join with the sum up to a year, as `total_<value>`."""
    total = (
        fact.filter(F.col(year) <= until)
        .groupBy(key)
        .agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias(f"total_{value}"))
    )
    return fact.join(total, key, "left")
