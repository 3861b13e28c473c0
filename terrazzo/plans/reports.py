"""Report queries over the gold table and the district dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.errors import LayerError
from terrazzo.functions.air import document_label, variant_label
from terrazzo.functions.classes import price_step
from terrazzo.functions.codes import code_of_district, parse_district
from terrazzo.operators.aggregates import means
from terrazzo.operators.exact import exact_totals, mean_of
from terrazzo.operators.filters import matching
from terrazzo.operators.sketches import merged, quantile, rows_of
from terrazzo.operators.joins import with_dimension, with_label
from terrazzo.operators.windows import all_years_total, running_total, yearly_change
from terrazzo.schemas import ROOM_CLASSES, SURFACE_CLASSES
from terrazzo.sources.reference import district_labels
from terrazzo.streaming.live import lookup

CITY = "Paris (tous arrondissements)"
PERSONS_PER_DWELLING = 2.2


def _rate(part: Column, whole: Column) -> Column:
    """Percentage with one decimal, 0 where the whole is missing or not positive."""
    return F.when(whole > 0, F.round(part * 100.0 / whole, 1)).otherwise(0.0)


def kpi(gold: DataFrame, dimension: DataFrame, year: int, district: str | int | None = None) -> DataFrame:
    """Key figures per district for a year.

    The price change and the social dwellings so far come from windows over the district's
    years, so the gold table is read once; the year is picked after them.
    """
    wanted = parse_district(district)
    rows = matching(gold, arrondissement=wanted).select(
        "arrondissement",
        "annee",
        "prix_m2_median",
        "nb_transactions",
        "revenu_median_arr",
        "taux_delinquance_global",
        "taux_delinquance_pmille",
        running_total("nb_logements_sociaux").alias("_social"),
        yearly_change("prix_m2_median").alias("variation"),
    )
    joined = with_dimension(
        rows.filter(F.col("annee") == year), dimension, ["nom", "densite_population", "nb_residences_principales"]
    )
    return joined.select(
        "arrondissement",
        F.col("annee").alias("year"),
        "nom",
        "prix_m2_median",
        F.col("nb_transactions").alias("transactions_total"),
        F.col("revenu_median_arr").alias("revenu_median"),
        "taux_delinquance_global",
        "taux_delinquance_pmille",
        "densite_population",
        _rate(F.col("_social"), F.col("nb_residences_principales")).alias("tx_logement_sociaux"),
        "variation",
    ).orderBy("arrondissement")


def kpi_with_air(rows: DataFrame, labels: DataFrame, air: DataFrame) -> DataFrame:
    """Key figures with a label, the district's name or where it has none the label of `labels`,
    and the live air label."""
    named = with_label(rows, labels.withColumnRenamed("nom", "label"), name="label").withColumn(
        "label", F.coalesce(F.nullif("nom", F.lit("")), "label")
    )
    live = air.select(F.col("insee").alias("_code"), F.col("air_label").alias("air_quality_global"))
    return named.join(live, code_of_district("arrondissement") == F.col("_code"), "left").drop("_code")


def kpi_city(rows: DataFrame) -> DataFrame:
    """One row for the whole city from the rows of `kpi`: prices, change and income weighted by
    sales, the rest plain means. No row if there is none to average."""
    weights = F.col("transactions_total")
    by_sales = ("prix_m2_median", "variation", "revenu_median")
    plain = ("densite_population", "tx_logement_sociaux", "taux_delinquance_global", "taux_delinquance_pmille")
    return (
        means(
            rows,
            ["year"],
            weighted={c: (F.col(c), weights) for c in by_sales},
            simple={c: F.col(c) for c in plain},
            wholes={"transactions_total": weights, "_rows": F.lit(1)},
        )
        # without sales the number of rows
        .withColumn("transactions_total", F.coalesce(F.nullif("transactions_total", F.lit(0)), "_rows"))
        .drop("_rows")
        .withColumns({"arrondissement": F.lit(0), "nom": F.lit(CITY), "label": F.lit(CITY)})
    )


def kpi_sets(gold: DataFrame, dimension: DataFrame, year: int) -> DataFrame:
    """The rows of `kpi` and, as district 0, the row of `kpi_city`, from one aggregate with two groupings.

    Figures whose type differs between the two have the wider one; `kpi_districts` and `kpi_whole_city` give each report as it is.
    """
    rows = kpi(gold, dimension, year)
    weights = F.col("transactions_total")
    by_sales = ("prix_m2_median", "variation", "revenu_median")
    plain = ("densite_population", "tx_logement_sociaux", "taux_delinquance_global", "taux_delinquance_pmille")
    both = means(
        rows,
        ["year", "arrondissement"],
        weighted={c: (F.col(c), weights) for c in by_sales},
        simple={c: F.col(c) for c in plain},
        wholes={"_sales": weights, "_rows": F.lit(1)},
        sets=[["year", "arrondissement"], ["year"]],
        kept={f"_{c}": F.col(c) for c in ("nom", "transactions_total", *by_sales, *plain)},
    )
    whole = F.col("grouping_bits") > 0
    return both.select(
        F.when(whole, 0).otherwise(F.col("arrondissement").cast("int")).alias("arrondissement"),
        "year",
        F.when(whole, CITY).otherwise(F.col("_nom")).alias("nom"),
        F.when(whole, F.coalesce(F.nullif("_sales", F.lit(0)), "_rows")).otherwise(F.col("_transactions_total")).alias("transactions_total"),
        *[F.when(whole, F.col(c)).otherwise(F.col(f"_{c}").cast("double")).alias(c) for c in (*by_sales, *plain)],
    )


def kpi_districts(both: DataFrame, like: DataFrame) -> DataFrame:
    """The district rows of `kpi_sets`, in the columns and types of `kpi` (`like`)."""
    return both.filter("arrondissement > 0").select(*[F.col(f.name).cast(f.dataType) for f in like.schema]).orderBy("arrondissement")


def kpi_whole_city(both: DataFrame) -> DataFrame:
    """The city's row of `kpi_sets`, in the columns of `kpi_city`."""
    return both.filter("arrondissement = 0").withColumn("label", F.col("nom"))


def price_quantiles(
    sketches: DataFrame, shares: dict[str, float], district: str | int | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """Quantiles of the price of one district or the city over a range of years, from stored sketches: sales are not read."""
    rows = matching(sketches, arrondissement=parse_district(district))
    if years is not None:
        rows = rows.filter(F.col("annee").between(*years))
    one = merged(rows, columns=("prix_m2",))
    return one.select(rows_of("prix_m2").alias("n"), *[quantile("prix_m2", share).alias(name) for name, share in shares.items()])


def kpi_city_with_air(city: DataFrame, air: DataFrame) -> DataFrame:
    """The row of `kpi_city` with the air label found first."""
    return city.withColumn("air_quality_global", city_air_label(air).select("air_label").scalar())


def _split(gold: DataFrame, classes: list[tuple[str, str]], year: int, district: str | int | None) -> DataFrame:
    rows = matching(gold, annee=year, arrondissement=parse_district(district))
    totals = exact_totals(rows, [], {"_total": F.col("nb_transactions"), **{name: F.col(column) for name, column in classes}})
    shares = totals.select(mean_of("_total").alias("_total"), *[mean_of(name).alias(name) for name, _ in classes])
    first = classes[0][0]
    long = shares.filter(F.col(first).isNotNull()).unpivot(["_total"], [name for name, _ in classes], "id", "value")
    value, total = F.coalesce("value", F.lit(0.0)), F.coalesce("_total", F.lit(0.0))
    # ties go to the even count
    return long.select(
        "id", value.alias("value"), F.bround(value / 100 * total, 0).cast("long").alias("count"), total.cast("long").alias("total")
    )


def typology(gold: DataFrame, year: int, district: str | int | None = None) -> DataFrame:
    """Mean share per room class, the number of sales it stands for, and the mean number of all sales."""
    return _split(gold, list(ROOM_CLASSES), year, district)


def surfaces(gold: DataFrame, year: int, district: str | int | None = None) -> DataFrame:
    """Mean share per surface class, the number of sales it stands for, and the mean number of all sales."""
    return _split(gold, [(name, column) for name, column, _, _ in SURFACE_CLASSES], year, district)


def price_history(gold: DataFrame, district: str | int | None = None) -> DataFrame:
    """Median price per year, of one district or weighted by sales over all."""
    wanted = parse_district(district)
    priced = gold.filter(F.col("prix_m2_median").isNotNull())
    if wanted is not None:
        yearly = matching(priced, arrondissement=wanted).select(
            F.col("annee").alias("year"), F.col("prix_m2_median").alias("median_price_per_sqm")
        )
    else:
        weights = F.coalesce("nb_transactions", F.lit(1))
        totals = exact_totals(
            priced.withColumnRenamed("annee", "year"), ["year"], {"_sales": F.col("prix_m2_median") * weights}, {"_weights": weights}
        )
        yearly = totals.select("year", F.round(F.try_divide("_sales", "_weights"), 0).alias("median_price_per_sqm"))
    return yearly.filter(F.col("median_price_per_sqm").isNotNull()).orderBy("year")


def map_prices(gold: DataFrame, year: int) -> DataFrame:
    """Area code, median price and legend step."""
    return (
        matching(gold, annee=year)
        .filter(F.col("prix_m2_median").isNotNull())
        .select(
            code_of_district("arrondissement").alias("code"),
            F.col("prix_m2_median").alias("price"),
            price_step(F.col("prix_m2_median")).alias("step"),
        )
        .orderBy("code")
    )


def data_table(gold: DataFrame, dimension: DataFrame, year: int) -> DataFrame:
    """Summary table of a year; a district without a name gets its default label. The social rate differs from `kpi`: dwellings of all years over
    dwellings estimated from the population."""
    rows = gold.select(
        "arrondissement",
        "annee",
        "prix_m2_median",
        yearly_change("prix_m2_median").alias("variation"),
        "nb_transactions",
        "revenu_median_arr",
        all_years_total("nb_logements_sociaux").alias("_social"),
    ).filter(F.col("annee") == year)
    dwellings = F.col("population_2020") / F.lit(PERSONS_PER_DWELLING)
    named = district_labels(gold.sparkSession).withColumnRenamed("nom", "_default")
    return (
        with_label(with_dimension(rows, dimension, ["nom", "population_2020", "densite_population"]), named, name="_default")
        .select(
            "arrondissement",
            F.coalesce(F.nullif("nom", F.lit("")), "_default").alias("nom"),
            "prix_m2_median",
            "variation",
            "nb_transactions",
            _rate(F.col("_social"), dwellings).alias("tx_logement_sociaux"),
            "revenu_median_arr",
            "densite_population",
        )
        .orderBy("arrondissement")
    )


def district_list(dimension: DataFrame) -> DataFrame:
    return dimension.select(
        "arrondissement", "code_insee", "nom", "code_postal", "superficie_km2", "population_2020"
    ).orderBy("arrondissement")


def _listing(gold: DataFrame, district: int | None, year: int | None, columns: list[str]) -> DataFrame:
    rows = matching(gold, arrondissement=district, annee=year)
    return rows.select("arrondissement", "annee", *columns).orderBy("arrondissement", "annee")


def transactions(gold: DataFrame, district: int | None = None, year: int | None = None) -> DataFrame:
    return _listing(
        gold, district, year,
        ["nb_transactions", "prix_m2_median", "prix_m2_moyen", "prix_m2_q1", "prix_m2_q3", "surface_mediane", "part_appartements"],
    )


def social_housing(gold: DataFrame, district: int | None = None, year: int | None = None) -> DataFrame:
    return _listing(gold, district, year, ["nb_logements_sociaux", "nb_plai", "nb_plus_pluscd", "nb_pls"])


def crime(gold: DataFrame, district: int | None = None, year: int | None = None) -> DataFrame:
    return _listing(
        gold, district, year, ["taux_cambriolages_pmille", "taux_violences_pmille", "taux_delinquance_global"]
    )


def incomes(gold: DataFrame, district: int | None = None) -> DataFrame:
    return (
        matching(gold, arrondissement=district)
        .select("arrondissement", "revenu_median_arr", "indice_gini_arr", "rapport_interdecile_arr")
        .distinct()
        .orderBy("arrondissement")
    )


def composite(gold: DataFrame, dimension: DataFrame, year: int | None = None) -> DataFrame:
    """Every gold column with three of the dimension."""
    rows = with_dimension(matching(gold, annee=year), dimension, ["nom", "code_postal", "superficie_km2"])
    return rows.orderBy("arrondissement", "annee")


def live_air(readings: DataFrame, district: int | None = None, as_of: dt.datetime | None = None) -> DataFrame:
    """Live air documents by code, of one district or all; expired ones are left out as in `lookup`."""
    return lookup(readings, "insee", None if district is None else str(75100 + district), as_of)


def require_rows(df: DataFrame) -> DataFrame:
    """Return the report, or raise if it is empty. Runs the report up to its first row."""
    if df.isEmpty():
        raise LayerError("no data for this selection")
    return df


def air_labels(documents: DataFrame) -> DataFrame:
    """Code and air label of live documents `(insee, document)`, held as variants or as JSON text."""
    label = variant_label if isinstance(documents.schema["document"].dataType, T.VariantType) else document_label
    return documents.select("insee", label(F.col("document"), F.col("insee")).alias("air_label"))


def city_air_label(labels: DataFrame) -> DataFrame:
    """The first label found, in the order of codes."""
    return labels.filter(F.col("air_label").isNotNull()).orderBy("insee").limit(1)
