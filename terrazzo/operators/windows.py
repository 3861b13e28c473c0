"""Window calculations over the gold table and over report rows.

All of them partition by district or report: at most one row per year or class, whatever the
number of sales behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrazzo.functions.numbers import percent_change


def _by_year(key: str, year: str):
    return Window.partitionBy(key).orderBy(year)


def previous_year(value: str, key: str = "arrondissement", year: str = "annee") -> Column:
    """The value one year before; null if that year is missing, even when an older one exists."""
    w = _by_year(key, year)
    return F.when(F.lag(year).over(w) == F.col(year) - 1, F.lag(value).over(w))


def yearly_change(value: str, key: str = "arrondissement", year: str = "annee") -> Column:
    """Change in percent against the year before."""
    return percent_change(F.col(value), previous_year(value, key, year))


def running_total(value: str, key: str = "arrondissement", year: str = "annee") -> Column:
    """Sum up to and including the row's year, nulls as zero."""
    w = _by_year(key, year).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(F.coalesce(F.col(value), F.lit(0))).over(w)


def all_years_total(value: str, key: str = "arrondissement") -> Column:
    """Sum over all years, nulls as zero."""
    return F.sum(F.coalesce(F.col(value), F.lit(0))).over(Window.partitionBy(key))


def min_max_scaled(value: str, *keys: str) -> Column:
    """Position between the smallest (0) and largest (1) value of the series; a flat series gives 0."""
    w = Window.partitionBy(*keys)
    low, high = F.min(value).over(w), F.max(value).over(w)
    spread = F.when(high == low, F.lit(1)).otherwise(high - low)
    return (F.col(value) - low) / spread


def share_of_total(value: str, *keys: str) -> Column:
    """Part of the sum of positive values; null for rows that are not positive."""
    positive = F.when(F.col(value) > 0, F.col(value))
    return positive / F.sum(positive).over(Window.partitionBy(*keys))


def bar_scaled(value: str, *keys: str) -> Column:
    """Value over the largest one of the report, the largest counting as at least one."""
    amount = F.coalesce(F.col(value), F.lit(0))
    largest = F.greatest(F.max(amount).over(Window.partitionBy(*keys)), F.lit(1))
    return F.greatest(amount / largest, F.lit(0))


def unpivoted(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row per metric: keys, `metric`, `value` (nulls kept)."""
    return df.unpivot(keys, [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")


def compared(df: DataFrame, key: str, first: int, second: int, metrics: list[str]) -> DataFrame:
    """Two districts side by side: each metric and its value over max(1, both values).

    A null metric counts as zero. Comparing a district with itself is an error.
    """
    if first == second:
        raise ValueError("choose two different districts")
    rows = unpivoted(df.filter(F.col(key).isin(first, second)), [key], metrics)

    def side(wanted: int) -> Column:
        return F.coalesce(F.max(F.when(F.col(key) == wanted, F.col("value"))), F.lit(0.0))

    pairs = rows.groupBy("metric").agg(side(first).alias("value_a"), side(second).alias("value_b"))
    largest = F.greatest(F.lit(1.0), "value_a", "value_b")
    return pairs.withColumns({"scaled_a": F.col("value_a") / largest, "scaled_b": F.col("value_b") / largest})
