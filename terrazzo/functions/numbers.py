"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """Quotient, null where the denominator is null or zero."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if digits is None else F.round(quotient, digits)


def sum_of(*columns: Column) -> Column:
    """Sum of columns, a null counting as zero."""
    total = F.coalesce(columns[0], F.lit(0))
    for column in columns[1:]:
        total = total + F.coalesce(column, F.lit(0))
    return total


def km2(square_metres: Column) -> Column:
    return F.round(square_metres / 1_000_000, 3)


def percent_change(current: Column, previous: Column) -> Column:
    """Change in percent, two decimals; null unless the previous value is positive."""
    return F.when(previous > 0, F.round((current - previous) / previous * 100, 2))


def share_of(flag: Column) -> Column:
    """Aggregate: percentage of rows where the flag holds, a null flag counting as no."""
    return F.round(F.avg(F.when(flag, 1).otherwise(0)) * 100, 2)


#: holds a total of 10^26 and parts of 10^-12
WIDE = "decimal(38,12)"


def exact_sum(value: Column) -> Column:
    """Aggregate: sum, of values of a known range, that does not depend on the order of rows.

    Adds decimals of twelve places, so a total that ends in a half always rounds the same way. NaN is left out like null; infinities give that infinity,
    or NaN where both occur. Beyond 10^26, ANSI mode raises instead of wrapping: `operators.exact` sums values of any size.
    """  # noqa: E501
    infinity = float("inf")
    finite = F.when(F.abs(value) < infinity, value)
    up, down = F.count_if(value == infinity) > 0, F.count_if(value == -infinity) > 0
    total = F.sum(finite.cast(WIDE)).cast("double")
    return F.when(up & down, float("nan")).when(up, infinity).when(down, -infinity).otherwise(total)


def exact_avg(value: Column) -> Column:
    """Aggregate: mean of the numbers, see `exact_sum`; null without any."""
    double = value.cast("double")
    return F.try_divide(exact_sum(value), F.count(F.when(~F.isnan(double), double)).cast("double"))
