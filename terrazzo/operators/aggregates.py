"""Aggregations by district and year.

Each source is aggregated in one grouping with conditional aggregates, so it is shuffled once,
after map-side combining down to one row per group and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.functions.classes import room_flags, surface_flags
from terrazzo.functions.codes import in_city
from terrazzo.functions.numbers import exact_avg, share_of
from terrazzo.operators.exact import exact_totals, mean_of, number
from terrazzo.operators.filters import contains_any
from terrazzo.operators.quantiles import exact_quantiles
from terrazzo.schemas import GOLD_KEY

SALE_QUANTILES = {
    "prix_m2_median": ("prix_m2", 0.5),
    "prix_m2_q1": ("prix_m2", 0.25),
    "prix_m2_q3": ("prix_m2", 0.75),
    "surface_mediane": ("surface_reelle_bati", 0.5),
}


def sale_measures() -> dict[str, Column]:
    """Aggregates over sales other than quantiles."""
    kept = F.count_if(F.col("type_local") == "Appartement")
    return {
        "nb_transactions": F.count("*"),
        "prix_m2_moyen": F.round(exact_avg(F.col("prix_m2")), 2),
        **{name: share_of(flag) for name, flag in room_flags(F.col("nombre_pieces_principales")).items()},
        **{name: share_of(flag) for name, flag in surface_flags(F.col("surface_reelle_bati")).items()},
        # null, not zero, where the category is absent
        "part_appartements": F.round(F.nullif(kept, F.lit(0)) / F.count("*") * 100, 2),
    }


def sale_indicators(
    sales: DataFrame,
    keys: tuple[str, ...] = GOLD_KEY,
    accuracy: int | None = None,
    quantiles: dict[str, tuple[str, float]] = SALE_QUANTILES,
) -> DataFrame:
    """Counts, mean, quantiles and shares of sales; `quantiles` may name fewer, or none.

    With `accuracy` the quantiles are sketched in the same pass (`percentile_approx`, one sketch
    per column). Without it they are exact, from counts of each distinct value; see `exact_quantiles`.
    """
    measures = [column.alias(name) for name, column in sale_measures().items()]
    if accuracy is None:
        totals = sales.groupBy(*keys).agg(*measures)
        if not quantiles:
            return totals
        return totals.join(exact_quantiles(sales, keys, quantiles), list(keys), "left")

    by_column: dict[str, list[str]] = {}
    for name, (column, _) in quantiles.items():
        by_column.setdefault(column, []).append(name)
    sketches = {
        column: F.percentile_approx(column, [quantiles[name][1] for name in names], accuracy)
        for column, names in by_column.items()
    }
    sketched = sales.groupBy(*keys).agg(*measures, *[s.alias(f"_{column}") for column, s in sketches.items()])
    picked = {name: F.col(f"_{column}")[i] for column, names in by_column.items() for i, name in enumerate(names)}
    return sketched.withColumns(picked).drop(*[f"_{column}" for column in sketches]) if picked else sketched


def category_share(df: DataFrame, keys: tuple[str, ...], is_wanted: Column, name: str) -> DataFrame:
    """Percentage of rows in a category; null where the group has none."""
    wanted = F.nullif(F.count_if(is_wanted), F.lit(0))
    return df.groupBy(*keys).agg(F.round(wanted / F.count("*") * 100, 2).alias(name))


def housing_totals(housing: DataFrame, keys: tuple[str, ...] = GOLD_KEY) -> DataFrame:
    """Social dwellings by kind of financing."""
    return housing.groupBy(*keys).agg(
        F.sum("nb_logmt_total").alias("nb_logements_sociaux"),
        F.sum("nb_plai").alias("nb_plai"),
        F.sum("nb_plus").alias("nb_plus_pluscd"),
        F.sum("nb_pls").alias("nb_pls"),
    )


BURGLARY_TERMS = ["cambriolage"]
VIOLENCE_TERMS = ["violence", "coups"]


def crime_rates(
    crime: DataFrame,
    keys: tuple[str, ...] = GOLD_KEY,
    burglary: list[str] = BURGLARY_TERMS,
    violence: list[str] = VIOLENCE_TERMS,
    ignore_case: bool = False,
) -> DataFrame:
    """Long indicator rows to one row per group, kinds being found by terms in the label.

    A kind without any row stays null. The label sources spell in lower case by default; `ignore_case` accepts both. Figures that are no number
    are left out; a total that is no whole number of 64 bits is null.
    """
    label, rate = F.col("indicateur"), F.col("taux_pour_mille")
    sums = {
        "_number": F.col("nombre"),
        "_rate": rate,
        "taux_cambriolages_pmille": F.when(contains_any(label, burglary, ignore_case), rate),
        "taux_violences_pmille": F.when(contains_any(label, violence, ignore_case), rate),
    }
    return exact_totals(crime, list(keys), sums).select(
        *keys,
        F.col("_number").try_cast("bigint").alias("taux_delinquance_global"),
        F.round("_rate", 1).alias("taux_delinquance_pmille"),
        "taux_cambriolages_pmille",
        "taux_violences_pmille",
    )


def income_means(incomes: DataFrame, key: str = "arrondissement") -> DataFrame:
    """Unweighted means of income zones per district."""
    sums = {"revenu_median_arr": F.col("DEC_MED18"), "indice_gini_arr": F.col("DEC_GI18"), "rapport_interdecile_arr": F.col("DEC_RD18")}
    digits = dict(zip(sums, (2, 4, 2), strict=True))
    totals = exact_totals(incomes.filter(in_city(key)), [key], sums)
    return totals.select(key, *[mean_of(name, n).alias(name) for name, n in digits.items()])


def range_figures(measure: str) -> dict[str, Column]:
    """Aggregates: least, greatest and mean value of a column."""
    return {f"{measure}_min": F.min(measure), f"{measure}_max": F.max(measure), f"{measure}_avg": F.avg(measure)}


def profile(df: DataFrame, measure: str, distinct: list[str] = (), total: list[str] = ()) -> DataFrame:
    """Quality figures of a table in one pass: rows, range, mean, distinct counts, totals."""
    return df.agg(
        F.count("*").alias("n_rows"),
        *[figure.alias(name) for name, figure in range_figures(measure).items()],
        *[F.count_distinct(c).alias(f"{c}_distinct") for c in distinct],
        *[F.sum(c).alias(f"{c}_total") for c in total],
    )


#: logarithm of the registers of a distinct sketch
DISTINCT_BITS = 14


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Relative standard error of a sketched distinct count; counts of a few hundred are exact or nearly so."""
    return 1.04 / 2 ** (bits / 2)


def distinct_figures(*columns: str, bits: int = DISTINCT_BITS) -> dict[str, Column]:
    """Aggregates: about how many distinct values a column holds, nulls not counted.

    A sketch of fixed size for each task, so the count can be taken by the pass that writes a table, without a shuffle of values.
    """
    return {f"{c}_distinct": F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(bits))) for c in columns}


def weight(column: Column) -> Column:
    """Weight of a row: null or zero counts as one."""
    return F.coalesce(F.nullif(column, F.lit(0)), F.lit(1))


def means(
    df: DataFrame,
    keys: list[str],
    weighted: dict[str, tuple[Column, Column]] | None = None,
    simple: dict[str, Column] | None = None,
    wholes: dict[str, Column] | None = None,
    digits: int = 2,
    sets: list[list[str]] | None = None,
    kept: dict[str, Column] | None = None,
) -> DataFrame:
    """The `keys`, weighted means of (value, weight) and simple means by name, and totals of whole numbers, for each group.

    Rows without a value, NaN being none, count neither as value nor as weight. Sums are exact at every magnitude. `sets` and `kept` as in
    `exact_totals`.
    """
    weighted, simple, kept = weighted or {}, simple or {}, kept or {}
    sums = dict(simple)
    for name, (value, weights) in weighted.items():
        counted = F.when(number(value).isNotNull(), weight(weights))
        sums |= {f"_{name}_product": value * counted, f"_{name}_weight": counted}
    totals = exact_totals(df, keys, sums, wholes, sets, kept)
    return totals.select(
        *keys,
        *[F.round(F.try_divide(F.col(f"_{name}_product"), F.col(f"_{name}_weight")), digits).alias(name) for name in weighted],
        *[mean_of(name, digits).alias(name) for name in simple],
        *(wholes or {}),
        *kept,
        *(["grouping_bits"] if sets else []),
    )


def total_or_rows(column: Column) -> Column:
    """Aggregate: the sum, or the number of rows where the sum is zero or null."""
    return F.coalesce(F.nullif(F.sum(column), F.lit(0)), F.count("*"))
