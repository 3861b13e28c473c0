"""Sources, sinks and bronze deliveries. Files are derived from the test tables by Spark, written
below the shared folder and read back through the library's readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrazzo.catalog import tables as t
from terrazzo.catalog.layers import AIR_COUNTS, AIR_DELIVERED, AIR_LABEL_SQL, AREAS
from terrazzo.catalog.registry import query
from terrazzo.catalog.sqltext import DIM, HOUSING, INCOMES, RAW_SALES, code
from terrazzo.functions.codes import area_codes, code_of_district
from terrazzo.operators.filters import with_ingestion_date
from terrazzo.operators.upserts import update_matched, upsert
from terrazzo.plans import bronze
from terrazzo.schemas import DISTRICT_FIGURES, INGESTION_DATE, POLLUTANTS, RAW_AIR, RAW_HOUSING, RAW_RESIDENCES, RAW_SALES as RAW_SALES_SCHEMA
from terrazzo.session import staging_path
from terrazzo.sources import files, sinks
from terrazzo.sources.air import air_rows, read_air
from terrazzo.sources.reference import population, seed_dimension

DATE, NEXT_DATE = "2026-06-24", "2026-06-25"

_COMMA = "replace(CAST({0} AS VARCHAR), '.', ',')"
_RAW_SALES_TEXT = (
    f"WITH {RAW_SALES} SELECT CAST(date_mutation AS VARCHAR) AS date_mutation, nature_mutation, "
    f"{_COMMA.format('valeur_fonciere')} AS valeur_fonciere, code_commune, type_local, "
    f"{_COMMA.format('surface_reelle_bati')} AS surface_reelle_bati, "
    "CAST(nombre_pieces_principales AS VARCHAR) AS nombre_pieces_principales FROM raw_sales"
)
_YMD = "'2026' AS ingestion_year, '06' AS ingestion_month, '24' AS ingestion_day"


def _sales_files(spark, sf) -> str:
    """Raw sales as CSV files in two folders, the years before 1998 and the others, written by one pass over the joined tables."""
    folder = staging_path(spark, "landing")
    before, later = bronze.SALES_FILES.split("*")
    # the writer names each folder `<column>=<value>`, which the pattern of the delivery matches
    part = F.when(F.col("date_mutation") < "1998", F.lit(f"a{later}")).otherwise(F.lit(f"b{later}"))
    raw = t.raw_sales(spark, sf, as_text=True).filter(F.col("date_mutation").isNotNull()).withColumn(f"{before}part", part)
    sinks.write_csv(raw, folder, by=[f"{before}part"])
    return folder


@query("source_csv_files", _RAW_SALES_TEXT)
def source_csv_files(spark, sf):
    return files.read_csv(spark, f"{_sales_files(spark, sf)}/{bronze.SALES_FILES}", schema=RAW_SALES_SCHEMA)


@query("bronze_sales", _RAW_SALES_TEXT.replace(" FROM raw_sales", f", {_YMD} FROM raw_sales"))
def bronze_sales(spark, sf):
    return with_ingestion_date(bronze.sales(spark, _sales_files(spark, sf), DATE), DATE)


_RESIDENCES = f"SELECT {code('s_nationkey + 1')} AS CODGEO, (count(*) * 1000) || '.75' AS P22_RP FROM supplier"


@query("source_csv_semicolon", f"{_RESIDENCES} GROUP BY s_nationkey")
def source_csv_semicolon(spark, sf):
    path = staging_path(spark, "csv")
    sinks.write_csv(t.raw_residences(spark, sf), path, sep=";")
    return files.read_csv(spark, path, sep=";", schema=RAW_RESIDENCES)


@query("bronze_residences", f"{_RESIDENCES} WHERE s_nationkey < 20 GROUP BY s_nationkey".replace(" FROM", f", {_YMD} FROM"))
def bronze_residences(spark, sf):
    folder = staging_path(spark, "landing")
    sinks.write_csv(t.raw_residences(spark, sf), f"{folder}/{bronze.RESIDENCES_FILE}", sep=";")
    return with_ingestion_date(bronze.residences(spark, folder, DATE), DATE)


_CRIME = (
    f"SELECT {code('user_id % 25 + 1')} AS CODGEO_2025, CAST(1995 + day(ts) % 7 AS VARCHAR) AS annee, event_type AS indicateur, "
    "CAST(event_id % 5 + 1 AS VARCHAR) AS nombre, value AS taux_pour_mille, 'fait' AS unite_de_compte, "
    "CASE WHEN value > 10 THEN 'diff' ELSE 'ndiff' END AS est_diffuse"
)


@query("source_parquet_members", f"{_CRIME} FROM events WHERE user_id % 25 + 1 BETWEEN 1 AND 20")
def source_parquet_members(spark, sf):
    path = staging_path(spark, "crime")
    t.raw_crime(spark, sf).write.parquet(path)
    return files.read_members(spark, path, "CODGEO_2025", area_codes())


@query("bronze_crime", f"{_CRIME}, {_YMD} FROM events WHERE user_id % 25 + 1 BETWEEN 1 AND 20")
def bronze_crime(spark, sf):
    folder = staging_path(spark, "landing")
    t.raw_crime(spark, sf).write.parquet(f"{folder}/{bronze.CRIME_FILE}")
    return with_ingestion_date(bronze.crime(spark, folder, DATE), DATE)


_HOUSING = """SELECT CAST(year(o_orderdate) AS VARCHAR) AS annee, CAST(c_nationkey + 1 AS BIGINT) AS arrdt,
  CAST(o_orderkey AS VARCHAR) AS adresse_programme, CAST(75001 + c_nationkey AS VARCHAR) AS code_postal,
  o_orderkey % 50 AS nb_logmt_total, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey % 7 END AS nb_plai,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 5 END AS nb_plus,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderkey % 3 END AS nb_pluscd, o_orderkey % 11 AS nb_pls,
  o_orderpriority AS mode_real, o_orderstatus AS nature_programme"""
_HOUSING_FROM = " FROM orders JOIN customer ON o_custkey = c_custkey"


@query("source_json_array", _HOUSING + _HOUSING_FROM)
def source_json_array(spark, sf):
    return files.read_json_array(spark, t.landed_json(t.raw_housing(spark, sf), "json", "adresse_programme"), RAW_HOUSING)


@query("bronze_housing", f"{_HOUSING}, {_YMD}{_HOUSING_FROM}")
def bronze_housing(spark, sf):
    folder = staging_path(spark, "landing")
    arrays = t.json_arrays(t.raw_housing(spark, sf), "adresse_programme")
    arrays.write.option("maxRecordsPerFile", 1).text(f"{folder}/{bronze.HOUSING_FILE}")
    return with_ingestion_date(bronze.housing(spark, folder, DATE), DATE)


_INCOMES = """SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN '931' ELSE '751' END || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0')
  || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS IRIS,
  CASE WHEN c_acctbal >= 0 THEN replace(CAST(c_acctbal AS VARCHAR), '.', ',') END AS DEC_MED18,
  '0,' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS DEC_GI18, (c_custkey % 9) || ',5' AS DEC_RD18"""


@query("bronze_incomes", f"{_INCOMES}, {_YMD} FROM customer")
def bronze_incomes(spark, sf):
    folder = staging_path(spark, "landing")
    padded = t.raw_incomes(spark, sf).withColumnRenamed("DEC_MED18", " DEC_MED18 ")
    padded.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(
        f"{folder}/{bronze.INCOMES_FILE}"
    )
    return with_ingestion_date(bronze.incomes(spark, folder, DATE), DATE)


@query(
    "bronze_districts",
    f"WITH {AREAS} SELECT arrondissement, superficie_km2, "
    f"list_value({', '.join(str(people) for _, _, people, _ in DISTRICT_FIGURES)})[arrondissement] AS population_totale, {_YMD} FROM areas",
)
def bronze_districts(spark, sf):
    folder = staging_path(spark, "landing")
    sinks.write_csv(t.raw_areas(spark, sf), f"{folder}/{bronze.DISTRICTS_FILE}", sep=";")
    return with_ingestion_date(bronze.districts(spark, folder, DATE), DATE)


_AIR_COLUMNS = ", ".join(f"{AIR_LABEL_SQL}[n_{p} + 1] AS {p}" for p in POLLUTANTS) + f", {AIR_LABEL_SQL}[n_no2 + 1] AS indice"


def _air_folder(spark, sf) -> str:
    """One JSON delivery per file."""
    folder = staging_path(spark, "landing")
    t.air_envelopes(spark, sf).write.option("maxRecordsPerFile", 1).json(f"{folder}/{bronze.AIR_FILE.format(date=DATE)}")
    return folder


@query(
    "source_air_envelope",
    f"WITH {AIR_DELIVERED} SELECT {code('arrondissement')} AS insee, arrondissement, CAST(fetched AS VARCHAR) AS fetched_at, "
    f"{code('arrondissement')} AS code, CAST(day AS VARCHAR) AS \"date\", {_AIR_COLUMNS} FROM air_delivered",
)
def source_air_envelope(spark, sf):
    return air_rows(read_air(spark, f"{_air_folder(spark, sf)}/{bronze.AIR_FILE.format(date=DATE)}"))


@query(
    "bronze_air",
    f"WITH {AIR_COUNTS} SELECT CAST(day AS VARCHAR) AS \"date\", CAST(count(*) AS INTEGER) AS nb_ok, 0 AS nb_erreurs, "
    f"CAST(count(*) AS INTEGER) AS n_districts, {_YMD} FROM air_counts GROUP BY day",
)
def bronze_air(spark, sf):
    delivered = bronze.air(spark, _air_folder(spark, sf), DATE)
    counted = delivered.select("date", "nb_ok", "nb_erreurs", F.size("arrondissements").alias("n_districts"))
    return with_ingestion_date(counted, DATE)


@query(
    "source_optional",
    "SELECT 'airparif' AS source, true AS found, count(DISTINCT CAST(ts AS DATE)) AS n_rows FROM events "
    "UNION ALL SELECT 'airparif tomorrow', false, 0",
)
def source_optional(spark, sf):
    """A missing optional delivery is skipped, a present one is read."""
    folder = _air_folder(spark, sf)
    today, tomorrow = bronze.air(spark, folder, DATE), bronze.air(spark, folder, NEXT_DATE)
    empty = spark.createDataFrame([], RAW_AIR)

    def status(name, df):
        rows = (empty if df is None else df).agg(F.count("*").alias("n_rows"))
        return rows.select(F.lit(name).alias("source"), F.lit(df is not None).alias("found"), "n_rows")

    return status("airparif", today).unionAll(status("airparif tomorrow", tomorrow))


@query(
    "source_reference_rows",
    "SELECT CAST(c_nationkey + 1 AS INTEGER) AS arrondissement, count(*) AS n_customers FROM customer WHERE c_nationkey < 20 GROUP BY 1",
)
def source_reference_rows(spark, sf):
    """Customers of the districts that the fixed reference rows know."""
    customers = t.table(spark, sf, "customer").select((F.col("c_nationkey") + 1).alias("arrondissement"))
    return customers.join(population(spark), "arrondissement").groupBy("arrondissement").agg(F.count("*").alias("n_customers"))


@query(
    "source_found_column",
    "SELECT CAST(c_nationkey + 1 AS VARCHAR) AS number, 'Numéro d''arrondissement' AS found FROM customer GROUP BY c_nationkey",
)
def source_found_column(spark, sf):
    """The number column is found by its name, after trimming the header."""
    raw = t.raw_areas(spark, sf)
    trimmed = files.trimmed_header(raw.toDF(*[f" {c} " for c in raw.columns]))
    name = files.find_column(trimmed, having="Num", lacking="INSEE")
    return trimmed.select(F.col(name).alias("number"), F.lit(name).alias("found"))


def _two_dates(spark, sf) -> str:
    """Silver housing: the early years ingested one day, the later ones the next."""
    root = staging_path(spark, "silver")
    df = t.housing(spark, sf)
    sinks.write_dated(df.filter("annee < 1998"), root, "logements_sociaux", DATE)
    sinks.write_dated(df.filter("annee >= 1998"), root, "logements_sociaux", NEXT_DATE)
    return root


@query("source_one_ingestion_date", f"WITH {HOUSING} SELECT *, {_YMD} FROM housing WHERE annee < 1998")
def source_one_ingestion_date(spark, sf):
    return files.read_ingestion(spark, _two_dates(spark, sf), "logements_sociaux", DATE)


@query(
    "source_silver_year",
    f"WITH {HOUSING} SELECT *, '2026' AS ingestion_year, '06' AS ingestion_month, '25' AS ingestion_day FROM housing WHERE annee = 1999",
)
def source_silver_year(spark, sf):
    return files.read_silver(spark, _two_dates(spark, sf), "logements_sociaux", year=1999)


@query("source_newest_date", f"WITH {HOUSING} SELECT count(*) AS n_rows, min(annee) AS first_year FROM housing WHERE annee >= 1998")
def source_newest_date(spark, sf):
    newest = files.read_newest(spark, _two_dates(spark, sf), "logements_sociaux")
    return newest.agg(F.count("*").alias("n_rows"), F.min("annee").alias("first_year"))


@query(
    "source_dates",
    "WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), newest AS (SELECT max(d) AS d FROM o) "
    "SELECT strftime(o.d, '%Y-%m-%d') AS date, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM o JOIN newest USING (d) GROUP BY 1",
)
def source_dates(spark, sf):
    """Every day of orders is an ingestion date: the newest is found by three listings and read from its own folder."""
    root = staging_path(spark, "layers")
    day = F.to_date("o_orderdate")
    dated = t.table(spark, sf, "orders").select("o_orderkey", *[F.date_format(day, f).alias(c) for c, f in zip(INGESTION_DATE, ("yyyy", "MM", "dd"))])
    dated.repartition(*INGESTION_DATE).write.partitionBy(*INGESTION_DATE).parquet(f"{root}/orders")
    newest = files.read_newest(spark, root, "orders")
    return newest.groupBy(F.concat_ws("-", *INGESTION_DATE).alias("date")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


def _pages(spark, sf):
    """Landed API pages of programmes, a page per line."""
    raw = t.raw_housing(spark, sf)
    total = t.table(spark, sf, "orders").agg(F.count("*")).scalar()
    chunk = F.floor(F.col("adresse_programme").cast("long") / 1000)
    pages = raw.groupBy(chunk.alias("page")).agg(F.collect_list(F.struct(*raw.columns)).alias("results"))
    path = staging_path(spark, "pages")
    pages.select(total.cast("int").alias("total_count"), "results").write.json(path)
    element = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in RAW_HOUSING)
    return spark.read.schema(f"total_count int, results array<struct<{element}>>").json(path)


@query("source_api_pages", _HOUSING + _HOUSING_FROM)
def source_api_pages(spark, sf):
    return files.records_of_pages(_pages(spark, sf))


@query(
    "source_api_page_totals",
    "SELECT count(*) AS n_records, count(*) AS total_count, true AS complete FROM orders",
)
def source_api_page_totals(spark, sf):
    return files.page_totals(_pages(spark, sf))


# ---- sinks -------------------------------------------------------------------------------


@query(
    "sink_dated_overwrite",
    f"WITH {HOUSING}, two AS (SELECT '24' AS ingestion_day, annee FROM housing WHERE annee < 1996 "
    "UNION ALL SELECT '25', annee FROM housing WHERE annee >= 1998) "
    "SELECT ingestion_day, count(*) AS n_rows, min(annee) AS first_year, max(annee) AS last_year FROM two GROUP BY 1",
)
def sink_dated_overwrite(spark, sf):
    """Writing a date again replaces that date and leaves the other."""
    root = _two_dates(spark, sf)
    sinks.write_dated(t.housing(spark, sf).filter("annee < 1996"), root, "logements_sociaux", DATE)
    rows = files.read_layer(spark, root, "logements_sociaux")
    return rows.groupBy("ingestion_day").agg(
        F.count("*").alias("n_rows"), F.min("annee").alias("first_year"), F.max("annee").alias("last_year")
    )


@query(
    "sink_update_matched",
    f"WITH {DIM} SELECT d.arrondissement, nom, coalesce(n.n, d.population_2020) AS population_2020 FROM dim d LEFT JOIN "
    "(SELECT s_nationkey + 1 AS arrondissement, CAST(count(*) AS INTEGER) AS n FROM supplier GROUP BY 1) n USING (arrondissement)",
)
def sink_update_matched(spark, sf):
    """Districts with suppliers are updated; those outside the dimension are not inserted."""
    counts = (
        t.table(spark, sf, "supplier")
        .groupBy((F.col("s_nationkey") + 1).alias("arrondissement"))
        .agg(F.count("*").alias("n"))
    )
    updated = update_matched(t.dimension(spark, sf), counts, "arrondissement", {"population_2020": "n"})
    return updated.select("arrondissement", "nom", "population_2020")


@query(
    "sink_upsert",
    f"""WITH {DIM}, seed AS (SELECT CAST(c_nationkey + 1 AS SMALLINT) AS arrondissement, 'new' AS nom,
    CAST(count(*) * 10 AS INTEGER) AS population_2020 FROM customer GROUP BY c_nationkey)
    SELECT arrondissement, coalesce(dim.nom, seed.nom) AS nom,
    CASE WHEN seed.arrondissement IS NOT NULL THEN seed.population_2020 ELSE dim.population_2020 END AS population_2020
    FROM dim FULL JOIN seed USING (arrondissement)""",
)
def sink_upsert(spark, sf):
    """Known districts get the new population and keep their name, others are inserted."""
    district = (F.col("c_nationkey") + 1).cast("smallint")
    counted = t.table(spark, sf, "customer").groupBy(district.alias("arrondissement")).agg(F.count("*").alias("n"))
    rows = counted.select("arrondissement", F.lit("new").alias("nom"), (F.col("n") * 10).cast("int").alias("population_2020"))
    dim = t.dimension(spark, sf).select("arrondissement", "nom", "population_2020")
    return upsert(dim, rows, "arrondissement", overwrite=["population_2020"])


@query(
    "sink_upsert_seed",
    "SELECT count(*) AS n_districts, CAST(sum(c) AS BIGINT) AS n_customers FROM (SELECT count(*) AS c FROM customer WHERE c_nationkey < 20 GROUP BY c_nationkey)",
)
def sink_upsert_seed(spark, sf):
    """Loading the reference rows twice changes nothing; the customers of its districts."""
    overwrite = ["superficie_km2", "population_2020", "densite_population"]
    seed = seed_dimension(spark)
    empty = spark.createDataFrame([], seed.schema)
    dim = upsert(upsert(empty, seed, "arrondissement", overwrite), seed, "arrondissement", overwrite)
    customers = t.table(spark, sf, "customer").groupBy((F.col("c_nationkey") + 1).alias("arrondissement")).agg(F.count("*").alias("c"))
    joined = dim.join(customers, "arrondissement")
    return joined.agg(F.count("*").alias("n_districts"), F.sum("c").alias("n_customers"))


@query(
    "sink_keyed_messages",
    f"SELECT {code('user_id % 20 + 1')} AS key, '{{\"insee\":\"' || {code('user_id % 20 + 1')} || '\",\"event_id\":' || event_id || "
    "',\"event_type\":\"' || event_type || '\"}' AS value FROM events",
)
def sink_keyed_messages(spark, sf):
    rows = t.table(spark, sf, "events").select(
        code_of_district(F.col("user_id") % 20 + 1).alias("insee"), "event_id", "event_type"
    )
    return sinks.as_messages(rows, "insee")


@query("sink_csv", f"WITH {INCOMES} SELECT IRIS, CAST(DEC_MED18 AS VARCHAR) AS DEC_MED18 FROM incomes")
def sink_csv(spark, sf):
    path = staging_path(spark, "csv")
    sinks.write_csv(t.incomes(spark, sf).select("IRIS", "DEC_MED18"), path)
    return files.read_csv(spark, path)
