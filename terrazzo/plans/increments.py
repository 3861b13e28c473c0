"""Gold after a new ingestion: only the districts and years whose silver rows changed are computed again.

A group's rows have a print: their number and sums of their hashes, which do not depend on the rows' order. Groups whose print
differs between two ingestions are touched. Prints are one light pass with partial sums, and may be stored, so that only the new ingestion is
read; quantiles and the other indicators are computed for touched groups alone.
"""  # noqa: E501

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrazzo.plans.gold import gold
from terrazzo.schemas import GOLD_KEY
from terrazzo.session import staged

#: values of a key column that are handed to the scan as a list
LISTED = 1000
_SUMS = ("_rows", "_p0", "_p1", "_p2")


def prints(df: DataFrame, *key: str) -> DataFrame:
    """key, number of rows and three sums of 21 bits of their hashes: the same for the same rows, repeated ones counted, in any order.

    Columns are hashed in the order of their names. Rows with a null in the key are a group like any other.
    """
    h = F.xxhash64(*sorted(df.columns))
    parts = [F.sum(F.shiftrightunsigned(h, 21 * i).bitwiseAND(F.lit((1 << 21) - 1))).alias(f"_p{i}") for i in range(3)]
    return df.groupBy(*key).agg(F.count("*").alias("_rows"), *parts)


def changed(before: DataFrame, after: DataFrame, *key: str) -> DataFrame:
    """Keys of the groups whose prints differ, those that only one side has among them."""
    signed = before.select(*key, *[(-F.col(c)).alias(c) for c in _SUMS]).unionByName(after.select(*key, *_SUMS))
    differs = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in _SUMS])
    return signed.groupBy(*key).agg(*[F.sum(c).alias(c) for c in _SUMS]).where(differs).select(*key)


def within(df: DataFrame, groups: DataFrame, *key: str) -> DataFrame:
    """Rows of `df` in one of the groups, nulls of the key equal.

    Values of the key columns go to the scan as lists, where they are few: files and row groups without any of them are not read. The join with the
    groups, which are few rows, leaves the rest exact.
    """  # noqa: E501
    for name in key:
        values = [r[0] for r in groups.select(name).distinct().limit(LISTED + 1).collect()]
        if len(values) <= LISTED and None not in values:
            df = df.where(F.col(name).isin(values))
    own = groups.select(*[F.col(c).alias(f"_g_{c}") for c in key]).distinct()
    return df.join(own, reduce(lambda a, b: a & b, [df[c].eqNullSafe(own[f"_g_{c}"]) for c in key]), "left_semi")


def silver_prints(sales: DataFrame, housing: DataFrame, crime: DataFrame, incomes: DataFrame) -> dict[str, DataFrame]:
    """Prints of the four sources of gold: by district and year, incomes by district."""
    by_year = {"sales": sales, "housing": housing, "crime": crime}
    return {**{name: prints(df, *GOLD_KEY) for name, df in by_year.items()}, "incomes": prints(incomes, GOLD_KEY[0])}


def touched_groups(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Districts and years to compute again: those of a changed group of any source, and all years of a district with changed incomes.

    Both sides: prints by source, see `silver_prints`.
    """
    moved = [changed(before[name], after[name], *GOLD_KEY) for name in ("sales", "housing", "crime")]
    districts = changed(before["incomes"], after["incomes"], GOLD_KEY[0])
    # a group of sales that went away has a key in what was before
    known = before["sales"].select(*GOLD_KEY).unionByName(after["sales"].select(*GOLD_KEY))
    of_districts = within_district(known, districts)
    return staged(reduce(DataFrame.unionByName, [*moved, of_districts]).distinct(), "touched")


def within_district(known: DataFrame, districts: DataFrame) -> DataFrame:
    district = GOLD_KEY[0]
    other = districts.select(F.col(district).alias("_district"))
    return known.join(other, known[district].eqNullSafe(other["_district"]), "left_semi")


def refreshed_gold(
    stored: DataFrame, touched: DataFrame, sales: DataFrame, housing: DataFrame, crime: DataFrame, incomes: DataFrame, **options
) -> DataFrame:
    """`stored`, the gold table before, with the touched districts and years computed again from the sources as they are now.

    Groups without sales any longer go, new ones come, all others stay as they are stored. `options` as of `gold.gold`; they must be those of the
    stored table. Columns of `stored` that gold does not compute are null in new rows.
    """  # noqa: E501
    parts = [within(df, touched, *GOLD_KEY) for df in (sales, housing, crime)]
    again = gold(*parts, within(incomes, touched, GOLD_KEY[0]), **options)
    own = touched.select(*[F.col(c).alias(f"_g_{c}") for c in GOLD_KEY])
    same = reduce(lambda a, b: a & b, [stored[c].eqNullSafe(own[f"_g_{c}"]) for c in GOLD_KEY])
    return stored.join(own, same, "left_anti").unionByName(again, allowMissingColumns=True)
