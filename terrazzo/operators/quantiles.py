"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


RESOLUTION = 256
#: bands of zero to the largest double, on each side
_SIDE = 2200 * RESOLUTION
#: distinct values of a band from which it is split again
SPLIT = 100_000


def value_band(value: Column) -> Column:
    """Number of the value's band. Larger values never get a smaller number.

    Bands are logarithmic at every magnitude (relative width about 1/370), zero has its own, and infinities are
    the outermost ones, so every double falls in one of a bounded number of them.
    """
    size = F.floor(F.log2(F.abs(value)) * RESOLUTION).cast("int") + F.lit(1100 * RESOLUTION)
    band = F.when(value == 0, 0).when(F.abs(value) == float("inf"), _SIDE).otherwise(size)
    return F.when(value < 0, -band).otherwise(band)


def exact_quantiles(
    df: DataFrame, keys: tuple[str, ...], wanted: dict[str, tuple[str, float | Callable[[Column], Column]]], split: int = SPLIT
) -> DataFrame:
    """Exact discrete quantiles per group; `wanted` maps an output name to (column, probability).

    The quantile is the smallest value with at least `probability` of the group's values at or below it. In place of the probability a function
    may give the rank, counted from 1, for the number of the group's values; ranks below 1 are 1. No task ever holds a group:

    1. Count rows per (group, value). Map-side combining leaves one small row per distinct value and task.
    2. Add the counts up per band of values; running totals over the bands tell in which one each wanted rank lies.
    3. Cut those bands, where they have more than `split` distinct values evenly between their least and largest value; running totals over the
       cuts tell in which one the rank lies.
    4. Take the value at the rank left over, among the values of those cuts only.

    Null and NaN are no values. Everything is one lazy plan, in which later steps read the exchanges of earlier
    ones: the source is scanned twice, for the values and for their bands.
    """  # noqa: E501
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    measure = {column: number for number, column in enumerate(columns)}
    number = {name: i for i, name in enumerate(wanted)}
    group = [*keys, "_m"]

    def joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        """Inner join in which null keys form a group of their own, as in any grouping."""
        renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
        return left.join(renamed, same).drop(*[f"_r_{c}" for c in on])

    doubles = [F.col(c).cast("double").alias(str(measure[c])) for c in columns]
    counts = (
        df.unpivot(list(keys), doubles, "_m", "_v")
        .filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
        # one zero: the negative one is equal but not the same
        .select(*keys, F.col("_m").cast("int").alias("_m"), F.when(F.col("_v") == 0, 0.0).otherwise(F.col("_v")).alias("_v"))
        .groupBy(*group, "_v")
        .agg(F.count("*").alias("_n"))
        .withColumn("_band", value_band(F.col("_v")))
    )
    whole = Window.partitionBy(*group)
    running = whole.orderBy("_band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bands = (
        counts.groupBy(*group, "_band")
        .agg(F.sum("_n").alias("_n"), F.ceil(F.count("*") / split).alias("_cuts"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        .withColumns({"_upto": F.sum("_n").over(running), "_all": F.sum("_n").over(whole)})
    )
    before = F.col("_upto") - F.col("_n")

    def rank_in_band(name: str) -> Column:
        column, probability = wanted[name]
        rank = probability(F.col("_all")) if callable(probability) else F.ceil(F.lit(float(probability)) * F.col("_all"))
        rank = F.greatest(F.lit(1), rank)
        hit = (F.col("_m") == measure[column]) & (rank > before) & (rank <= F.col("_upto"))
        return F.when(hit, rank - before)

    def some(ranks: str) -> Column:
        return F.exists(ranks, lambda rank: rank.isNotNull())

    # one array, not a column for each: many nullable columns make the optimizer slow
    ranks = F.array(*[rank_in_band(n) for n in wanted]).alias("_ranks")
    hits = bands.select(*group, "_band", "_cuts", "_low", "_high", ranks).filter(some("_ranks"))
    place = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    cut = F.when(F.col("_cuts") > 1, F.least(F.floor(place * F.col("_cuts")), F.col("_cuts") - 1)).otherwise(F.lit(0)).cast("long")
    # from here on the values of those bands only
    fine = joined(counts, hits, [*group, "_band"]).select(*group, "_band", "_v", "_n", cut.alias("_cut"))
    upwards = Window.partitionBy(*group, "_band").orderBy("_cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = joined(
        fine.groupBy(*group, "_band", "_cut").agg(F.sum("_n").alias("_n")).withColumn("_upto", F.sum("_n").over(upwards)),
        hits.select(*group, "_band", "_ranks"),
        [*group, "_band"],
    )
    left = F.transform("_ranks", lambda rank: F.when((rank > before) & (rank <= F.col("_upto")), rank - before))
    targets = steps.select(*group, "_band", "_cut", left.alias("_ranks")).filter(some("_ranks"))
    within = (
        Window.partitionBy(*group, "_band", "_cut").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = joined(fine, targets, [*group, "_band", "_cut"]).withColumn("_upto", F.sum("_n").over(within))

    def at_rank(name: str) -> Column:
        rank = F.get("_ranks", F.lit(number[name]))
        return F.max(F.when((rank > F.col("_upto") - F.col("_n")) & (rank <= F.col("_upto")), F.col("_v")))

    return placed.groupBy(*keys).agg(*[at_rank(name).alias(name) for name in wanted])
