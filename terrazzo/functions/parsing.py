"""Text to typed values. A malformed value becomes null and is counted, it never fails a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def decimal_text(value: Column | str) -> Column:
    """`'12,5'` or `'12.5'` to a double, null if it is not a number."""
    text = F.col(value) if isinstance(value, str) else value
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def to_double(df: DataFrame, column: str) -> Column:
    """Double of a column that is text in raw files but may already be typed."""
    return decimal_text(column) if is_text(df, column) else F.col(column).cast("double")


def decimals_to_double(df: DataFrame, columns: list[str]) -> DataFrame:
    """Convert the named columns that are present, leave the others."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_double(df, c) for c in present})


def whole(value: Column | str, dtype: str = "int") -> Column:
    """Text or number to a whole number type, null if malformed or out of range."""
    return (F.col(value) if isinstance(value, str) else value).try_cast(dtype)


def truncated(value: Column | str) -> Column:
    """Text with or without decimals to an int, dropping the fraction."""
    return (F.col(value) if isinstance(value, str) else value).try_cast("double").try_cast("int")


def iso_date(df: DataFrame, column: str) -> Column:
    """`yyyy-MM-dd` text to a date, null if malformed; typed columns are cast."""
    if is_text(df, column):
        return F.try_to_date(F.col(column), "yyyy-MM-dd")
    return F.col(column).cast("date")


def number_or_null(value: Column | str) -> Column:
    """NaN and malformed text to null."""
    number = (F.col(value) if isinstance(value, str) else value).try_cast("double")
    return F.when(~F.isnan(number), number)


def iso_utc(moment: Column) -> Column:
    """ISO 8601 text of an instant, in UTC whatever the zone of the session."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def rejected(raw: str, typed: Column) -> Column:
    """How many rows hold a value that could not be read (an aggregate)."""
    return F.count_if(F.col(raw).isNotNull() & typed.isNull())
