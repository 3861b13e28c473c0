"""Quantile sketches that are stored by district and year and merged to what a report asks for.

A sketch holds a few hundred values whatever the number of rows. Sketches of groups are merged to the city or to a range of years without reading
the sales again; the error of ranks is that of one sketch, for a merge adds none.
"""  # noqa: E501

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.schemas import GOLD_KEY

#: values that the largest level of a sketch holds
SIZE = 800
COLUMNS = ("prix_m2", "surface_reelle_bati")


def rank_error(size: int = SIZE) -> float:
    """How far the rank of a sketched quantile may be off, as a share of all rows, in 99 of 100 cases."""
    return 2.296 / size**0.9723


def sketched(df: DataFrame, keys: tuple[str, ...] = GOLD_KEY, columns: tuple[str, ...] = COLUMNS, size: int = SIZE) -> DataFrame:
    """One row for each group with `<column>_sketch`, in one pass; null where a group has no number. NaN is none."""

    def numbers(column: str) -> Column:
        value = F.col(column).cast("double")
        return F.when(~F.isnan(value), value)

    held = {c: F.count(numbers(c)).alias(f"_n_{c}") for c in columns}
    rows = df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(numbers(c), size).alias(f"{c}_sketch") for c in columns], *held.values())
    return rows.select(*keys, *[F.when(F.col(f"_n_{c}") > 0, F.col(f"{c}_sketch")).alias(f"{c}_sketch") for c in columns])


def merged(sketches: DataFrame, keys: tuple[str, ...] = (), columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """The sketches of larger groups; without keys one row for all."""
    return sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(f"{c}_sketch").alias(f"{c}_sketch") for c in columns])


def quantile(column: str, share: float) -> Column:
    """The quantile of a sketched column; null where there is no number."""
    sketch = F.col(f"{column}_sketch")
    return F.when(rows_of(column) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))


def rows_of(column: str) -> Column:
    """The numbers that a sketch has seen."""
    sketch = F.col(f"{column}_sketch")
    return F.when(sketch.isNull(), F.lit(0).cast("bigint")).otherwise(F.kll_sketch_get_n_double(sketch))
