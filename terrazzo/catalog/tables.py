"""The test tables in the shape of the domain's raw deliveries.

Sales are line items with their order and customer, districts are nations (1..20 of 25 belong to
the city), crime rows are events, income zones and residences are customers, social housing
programmes are orders. The SQL twins of these shapes are in `sqltext`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.functions.air import AIR_LABELS
from terrazzo.functions.codes import code_of_district, in_city
from terrazzo.operators.aggregates import SALE_QUANTILES
from terrazzo.plans import gold as gold_plan
from terrazzo.plans import silver
from terrazzo.schemas import POLLUTANTS
from terrazzo.session import staged, staging_path

BURGLARY = ["purchase"]
VIOLENCE = ["error", "sign"]


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is looked up once, the data are read each time."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _text(value: Column) -> Column:
    """Number as text with a decimal comma."""
    return F.replace(value.cast("string"), F.lit("."), F.lit(","))


def raw_sales(spark: SparkSession, sf: str, as_text: bool = False) -> DataFrame:
    """Raw sales, typed or as the text of a CSV file."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    lines = table(spark, sf, "lineitem")
    joined = lines.join(
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey")
    )
    df = joined.select(
        F.to_date("o_orderdate").alias("date_mutation"),
        F.col("l_linestatus").alias("nature_mutation"),
        F.col("l_extendedprice").alias("valeur_fonciere"),
        code_of_district(F.col("c_nationkey") + 1).alias("code_commune"),
        F.when(F.col("l_returnflag") == "N", "Maison").otherwise("Appartement").alias("type_local"),
        (F.col("l_quantity") * 3).alias("surface_reelle_bati"),
        F.col("l_linenumber").alias("nombre_pieces_principales"),
    )
    if not as_text:
        return df
    return df.withColumns(
        {
            "date_mutation": F.date_format("date_mutation", "yyyy-MM-dd"),
            "valeur_fonciere": _text(F.col("valeur_fonciere")),
            "surface_reelle_bati": _text(F.col("surface_reelle_bati")),
            "nombre_pieces_principales": F.col("nombre_pieces_principales").cast("string"),
        }
    )


def raw_crime(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        code_of_district(F.col("user_id") % 25 + 1).alias("CODGEO_2025"),
        (F.lit(1995) + F.dayofmonth("ts") % 7).cast("string").alias("annee"),
        F.col("event_type").alias("indicateur"),
        (F.col("event_id") % 5 + 1).cast("string").alias("nombre"),
        F.col("value").alias("taux_pour_mille"),
        F.lit("fait").alias("unite_de_compte"),
        F.when(F.col("value") > 10, "diff").otherwise("ndiff").alias("est_diffuse"),
    )


def raw_housing(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    key = F.col("o_orderkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.date_format("o_orderdate", "yyyy").alias("annee"),
        (F.col("c_nationkey") + 1).cast("long").alias("arrdt"),
        key.cast("string").alias("adresse_programme"),
        (F.lit(75001) + F.col("c_nationkey")).cast("string").alias("code_postal"),
        (key % 50).alias("nb_logmt_total"),
        F.when(F.col("o_orderpriority") != "1-URGENT", key % 7).alias("nb_plai"),
        F.when(F.col("o_orderpriority") != "5-LOW", key % 5).alias("nb_plus"),
        F.when(F.col("o_orderstatus") != "F", key % 3).alias("nb_pluscd"),
        (key % 11).alias("nb_pls"),
        F.col("o_orderpriority").alias("mode_real"),
        F.col("o_orderstatus").alias("nature_programme"),
    )


def raw_incomes(spark: SparkSession, sf: str) -> DataFrame:
    """Income zones as text; zones outside the city and empty figures occur."""
    city = F.when(F.col("c_mktsegment") == "MACHINERY", "931").otherwise("751")
    zone = F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")
    return table(spark, sf, "customer").select(
        F.concat(city, F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), zone).alias("IRIS"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(_text(F.col("c_acctbal"))).alias("DEC_MED18"),
        F.concat(F.lit("0,"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0")).alias("DEC_GI18"),
        F.concat((F.col("c_custkey") % 9).cast("string"), F.lit(",5")).alias("DEC_RD18"),
    )


def raw_areas(spark: SparkSession, sf: str) -> DataFrame:
    """District areas under the delivery's column names, as text; the more customers, the larger."""
    n = F.col("c_nationkey") + 1
    counted = table(spark, sf, "customer").groupBy(n.alias("n")).agg(F.count("*").alias("customers"))
    return counted.select(
        F.col("n").cast("string").alias("Numéro d'arrondissement"),
        code_of_district("n").alias("Numéro d'arrondissement INSEE"),
        F.concat(((F.col("customers") + 100) * 12345).cast("string"), F.lit(".5")).alias("Surface"),
    )


def people(spark: SparkSession, sf: str) -> DataFrame:
    """Population per district, from the customers."""
    return (
        table(spark, sf, "customer")
        .groupBy((F.col("c_nationkey") + 1).alias("arrondissement"))
        .agg((F.count("*") * 40).cast("int").alias("population_totale"))
    )


def raw_residences(spark: SparkSession, sf: str) -> DataFrame:
    """Main residences per area code, as text with a fraction."""
    counted = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    return counted.select(
        code_of_district(F.col("s_nationkey") + 1).alias("CODGEO"),
        F.concat((F.col("n") * 1000).cast("string"), F.lit(".75")).alias("P22_RP"),
    )


def dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The district dimension; every sixth district has no residences."""
    n = F.col("n_nationkey")
    return (
        table(spark, sf, "nation")
        .select(
            (n + 1).cast("smallint").alias("arrondissement"),
            code_of_district(n + 1).alias("code_insee"),
            F.col("n_name").alias("nom"),
            (F.lit(75001) + n).cast("string").alias("code_postal"),
            F.round((n * 37 + 100) / 64, 3).alias("superficie_km2"),
            (n * 1300 + 16000).cast("int").alias("population_2020"),
            (n * 911 % 7000 + 9000).cast("int").alias("densite_population"),
            F.when(n % 6 == 0, 0).otherwise(n * 700 + 9000).cast("int").alias("nb_residences_principales"),
        )
        .filter(in_city("arrondissement"))
    )


def air_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """One air delivery per day, from the events of the day and the next: a map of code to
    readings per district. Counted per district and day first, so the nested lists stay small."""
    event_types = ("click", "error", "purchase", "signup", "view")
    n = F.col("user_id") % 20 + 1
    counts = (
        table(spark, sf, "events")
        .groupBy(n.cast("int").alias("arrondissement"), F.to_date("ts").alias("day"))
        .agg(*[F.count_if(F.col("event_type") == e).alias(p) for e, p in zip(event_types, POLLUTANTS)])
    )
    labels = F.array(*[F.lit(x) for x in AIR_LABELS])
    label = lambda p: F.get(labels, (F.col(p) % 6).cast("int"))
    readings = counts.select(
        "arrondissement",
        "day",
        F.struct(
            F.date_format("day", "yyyy-MM-dd").alias("date"),
            *[label(p).alias(p) for p in POLLUTANTS],
            label("no2").alias("indice"),
        ).alias("reading"),
    )
    # the reading of the day and, where there is one, of the next
    following = readings.select("arrondissement", F.date_sub("day", 1).alias("day"), F.col("reading").alias("following"))
    per_code = readings.join(following, ["arrondissement", "day"], "left").select(
        "arrondissement", "day", F.array_compact(F.array("reading", "following")).alias("readings")
    )
    code = code_of_district("arrondissement")
    return per_code.groupBy("day").agg(
        F.count("*").cast("int").alias("nb_ok"),
        F.collect_list(
            F.struct(
                code.alias("insee"),
                "arrondissement",
                F.date_format("day", "yyyy-MM-dd").alias("fetched_at"),
                F.create_map(code, F.col("readings")).alias("data"),
            )
        ).alias("arrondissements"),
    ).select(
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        "nb_ok",
        F.lit(0).alias("nb_erreurs"),
        "arrondissements",
        F.array().cast("array<struct<insee:string,error:string>>").alias("erreurs"),
    )


def json_arrays(df: DataFrame, key: str, per_array: int = 100_000) -> DataFrame:
    """Records as JSON arrays of at most `per_array` records, grouped by ranges of a unique key."""
    chunk = F.floor(F.col(key).cast("long") / per_array)
    arrays = df.groupBy(chunk.alias("_chunk")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    return arrays.select("value")


def landed_json(df: DataFrame, name: str, key: str) -> str:
    """Land records as files of one JSON array each; returns the folder."""
    path = staging_path(df.sparkSession, name)
    json_arrays(df, key).write.option("maxRecordsPerFile", 1).text(path)
    return path


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return silver.sales(raw_sales(spark, sf))


def crime(spark: SparkSession, sf: str) -> DataFrame:
    return silver.crime(raw_crime(spark, sf))


def housing(spark: SparkSession, sf: str) -> DataFrame:
    return silver.housing(raw_housing(spark, sf))


def incomes(spark: SparkSession, sf: str) -> DataFrame:
    return silver.incomes(raw_incomes(spark, sf))


def gold_sales(spark: SparkSession, sf: str) -> DataFrame:
    """The silver sales with the columns that gold reads."""
    return sales(spark, sf).select(
        "arrondissement", "annee", "type_local", "nombre_pieces_principales", "surface_reelle_bati", "prix_m2"
    )


def gold(
    spark: SparkSession, sf: str, *parts: str, quantiles: tuple[str, ...] = tuple(SALE_QUANTILES), stored: DataFrame | None = None
) -> DataFrame:
    """The gold table with the named parts besides sales and the named quantiles; the sales are the `stored` ones where there are any."""
    others = {"housing": housing, "crime": crime, "incomes": incomes}
    return gold_plan.gold(
        gold_sales(spark, sf) if stored is None else stored,
        **{p: others[p](spark, sf) for p in parts},
        quantiles={name: SALE_QUANTILES[name] for name in quantiles},
        **({"burglary": BURGLARY, "violence": VIOLENCE} if "crime" in parts else {}),
    )


_stored: dict[tuple[str, str], DataFrame] = {}


def stored_gold(spark: SparkSession, sf: str) -> DataFrame:
    """The whole gold table, built once for an application and read by all reports, as the gold layer is.

    Gold reads the sales three times, so they are joined and cleaned once and written, as the silver layer is.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        silver_sales = staged(gold_sales(spark, sf), "sales")
        _stored[key] = staged(gold(spark, sf, "housing", "crime", "incomes", stored=silver_sales), "gold")
    return _stored[key]
