"""Row filters. All are plain predicates, so Spark can push them into the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.schemas import INGESTION_DATE


def matching(df: DataFrame, **wanted) -> DataFrame:
    """Keep rows equal to every given value; a value of None sets no condition."""
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def contains_any(text: Column, terms: list[str], ignore_case: bool = False) -> Column:
    """The text holds at least one of the terms."""
    if ignore_case:
        text, terms = F.lower(text), [t.lower() for t in terms]
    return reduce(lambda a, b: a | b, [text.contains(t) for t in terms])


def has_prefix(text: Column, prefix: str) -> Column:
    """The text starts with the prefix; a missing text does not."""
    return F.coalesce(text.startswith(prefix), F.lit(False))


def present(df: DataFrame, columns: list[str]) -> list[str]:
    """The given columns that the table has, in the given order."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def with_ingestion_date(df: DataFrame, date: str) -> DataFrame:
    """Add the three partition columns of an ingestion date `yyyy-MM-dd`."""
    return df.select("*", *[F.lit(part).alias(name) for name, part in zip(INGESTION_DATE, date.split("-"))])


def on_ingestion_date(df: DataFrame, date: str) -> DataFrame:
    """Keep one ingestion date of a table."""
    return matching(df, **dict(zip(INGESTION_DATE, date.split("-"))))
