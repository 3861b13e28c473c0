"""Filters and scalar functions, each over a whole test table."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrazzo.catalog import tables as t
from terrazzo.catalog.layers import AIR_LABEL_SQL
from terrazzo.catalog.registry import SQL, query
from terrazzo.catalog.sqltext import INCOMES, RAW_SALES, code, half_up
from terrazzo.functions import classes, codes, numbers, parsing
from terrazzo.functions.air import document_label, severity, variant_label, worst_pollutants
from terrazzo.operators import filters
from terrazzo.operators.joins import with_label
from terrazzo.plans import silver
from terrazzo.schemas import DISTRICT_QUARTERS, INCOME_COLUMNS
from terrazzo.session import staged
from terrazzo.sources.reference import district_labels

QUARTERS = f"list_value({', '.join(repr(q) for q in DISTRICT_QUARTERS)})"

# ---- filters -----------------------------------------------------------------------------


@query("filter_area_code", f"WITH {RAW_SALES} SELECT code_commune, count(*) AS n FROM raw_sales WHERE code_commune BETWEEN '75101' AND '75120' GROUP BY 1")
def filter_area_code(spark, sf):
    return t.raw_sales(spark, sf).filter(codes.is_area_code("code_commune")).groupBy("code_commune").agg(F.count("*").alias("n"))


@query(
    "filter_sale_bounds",
    "SELECT l_orderkey, l_linenumber, l_quantity * 3 AS surface, l_extendedprice AS value FROM lineitem "
    "WHERE l_returnflag = 'R' AND l_quantity * 3 > 9 AND l_extendedprice > 10000",
)
def filter_sale_bounds(spark, sf):
    rows = filters.matching(t.table(spark, sf, "lineitem"), l_returnflag="R", l_linestatus=None)
    surface, value = F.col("l_quantity") * 3, F.col("l_extendedprice")
    kept = rows.filter((surface > silver.MIN_SURFACE) & (value > silver.MIN_VALUE))
    return kept.select("l_orderkey", "l_linenumber", surface.alias("surface"), value.alias("value"))


@query(
    "filter_price_range",
    f"SELECT l_orderkey, l_linenumber, {half_up('l_extendedprice / l_quantity', 2)} AS price FROM lineitem "
    f"WHERE {half_up('l_extendedprice / l_quantity', 2)} BETWEEN 500 AND 80000",
)
def filter_price_range(spark, sf):
    price = numbers.ratio(F.col("l_extendedprice"), F.col("l_quantity"), 2)
    rows = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", price.alias("price"))
    return rows.filter(F.col("price").between(*silver.PRICE_RANGE))


@query("filter_members", f"SELECT event_id, {code('user_id % 25 + 1')} AS code FROM events WHERE user_id % 25 + 1 BETWEEN 1 AND 20")
def filter_members(spark, sf):
    rows = t.table(spark, sf, "events").select("event_id", codes.code_of_district(F.col("user_id") % 25 + 1).alias("code"))
    return rows.filter(F.col("code").isin(codes.area_codes()))


@query("filter_prefix", "SELECT c_custkey, c_mktsegment FROM customer WHERE starts_with(c_mktsegment, 'MA')")
def filter_prefix(spark, sf):
    rows = t.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return rows.filter(filters.has_prefix(F.col("c_mktsegment"), "MA"))


@query("filter_terms", "SELECT event_id, event_type FROM events WHERE contains(event_type, 'chase') OR contains(event_type, 'sign')")
def filter_terms(spark, sf):
    rows = t.table(spark, sf, "events").select("event_id", "event_type")
    return rows.filter(filters.contains_any(F.col("event_type"), ["chase", "sign"]))


@query("filter_terms_any_case", "SELECT c_custkey, c_mktsegment FROM customer WHERE contains(lower(c_mktsegment), 'house')")
def filter_terms_any_case(spark, sf):
    rows = t.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return rows.filter(filters.contains_any(F.col("c_mktsegment"), ["House"], ignore_case=True))


@query("filter_district_range", "SELECT c_custkey, c_nationkey + 1 AS district FROM customer WHERE c_nationkey + 1 BETWEEN 1 AND 20")
def filter_district_range(spark, sf):
    rows = t.table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") + 1).alias("district"))
    return rows.filter(codes.in_city("district"))


@query("filter_when_given", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def filter_when_given(spark, sf):
    rows = filters.matching(t.table(spark, sf, "orders"), o_orderstatus="F", o_orderpriority="2-HIGH", o_custkey=None)
    return rows.select("o_orderkey")


@query("filter_present_columns", f"WITH {INCOMES} SELECT IRIS, DEC_MED18, DEC_GI18, DEC_RD18 FROM incomes")
def filter_present_columns(spark, sf):
    rows = t.incomes(spark, sf)
    return rows.select("IRIS", *filters.present(rows, list(INCOME_COLUMNS)))


@query("parse_request", """SELECT asked, CAST(CASE WHEN n BETWEEN 75101 AND 75120 THEN n - 75100 WHEN n BETWEEN 1 AND 20 THEN n END AS INTEGER) AS district,
  count(*) AS n_rows FROM (SELECT asked, try_cast(asked AS INTEGER) AS n FROM (
    SELECT CASE WHEN event_type = 'click' THEN 'all' WHEN event_type = 'error' THEN '' WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR)
                WHEN event_type = 'signup' THEN CAST(75095 + user_id % 40 AS VARCHAR) ELSE 'x' || user_id END AS asked FROM events)) GROUP BY ALL""")
def parse_request(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id")
    asked = (
        F.when(kind == "click", "all")
        .when(kind == "error", "")
        .when(kind == "view", user.cast("string"))
        .when(kind == "signup", (F.lit(75095) + user % 40).cast("string"))
        .otherwise(F.concat(F.lit("x"), user.cast("string")))
    )
    rows = t.table(spark, sf, "events").select(asked.alias("asked"))
    return rows.groupBy("asked", codes.district_of_request("asked").alias("district")).agg(F.count("*").alias("n_rows"))


@query(
    "ingestion_columns",
    "SELECT s_suppkey, '2026' AS ingestion_year, '06' AS ingestion_month, '24' AS ingestion_day FROM supplier",
)
def ingestion_columns(spark, sf):
    rows = filters.with_ingestion_date(t.table(spark, sf, "supplier").select("s_suppkey"), "2026-06-24")
    return filters.on_ingestion_date(rows, "2026-06-24")


# ---- text to values ----------------------------------------------------------------------


@query(
    "decimal_comma",
    "SELECT c_custkey, c_acctbal AS balance, CAST(NULL AS DOUBLE) AS broken FROM customer",
)
def decimal_comma(spark, sf):
    text = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    rows = t.table(spark, sf, "customer").select("c_custkey", text.alias("text"))
    broken = F.concat(F.lit("?"), F.col("text"))
    return rows.select("c_custkey", parsing.decimal_text("text").alias("balance"), parsing.decimal_text(broken).alias("broken"))


@query("decimal_columns", f"WITH {INCOMES} SELECT sum(CAST(DEC_MED18 IS NULL AS BIGINT))::BIGINT AS n_empty, min(DEC_MED18) AS lowest, max(DEC_GI18) AS highest FROM incomes")
def decimal_columns(spark, sf):
    return t.incomes(spark, sf).agg(
        F.count_if(F.col("DEC_MED18").isNull()).alias("n_empty"), F.min("DEC_MED18").alias("lowest"), F.max("DEC_GI18").alias("highest")
    )


@query(
    "whole_numbers",
    """SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS small, CAST(trunc(l_extendedprice) AS INTEGER) AS truncated,
    CASE WHEN l_orderkey <= 32767 THEN CAST(l_orderkey AS SMALLINT) END AS fitting FROM lineitem""",
)
def whole_numbers(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey",
        parsing.whole(F.col("l_linenumber").cast("string"), "smallint").alias("small"),
        parsing.truncated(F.col("l_extendedprice").cast("string")).alias("truncated"),
        parsing.whole(F.col("l_orderkey").cast("string"), "smallint").alias("fitting"),
    )


@query("dates_and_years", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(year(o_orderdate) AS INTEGER) AS annee, CAST(NULL AS INTEGER) AS broken FROM orders")
def dates_and_years(spark, sf):
    rows = t.table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("text"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("other"),
    )
    day = parsing.iso_date(rows, "text")
    return rows.select(
        "o_orderkey", day.cast("string").alias("day"), F.year(day).alias("annee"), F.year(parsing.iso_date(rows, "other")).alias("broken")
    )


@query(
    "malformed_counted",
    "SELECT count(*) AS n_rows, count(*) FILTER (l_returnflag = 'A') AS bad_valeur_fonciere, CAST(0 AS BIGINT) AS bad_surface_reelle_bati, "
    "count(*) FILTER (l_linenumber > 6) AS bad_nombre_pieces_principales, count(*) FILTER (l_linestatus = 'F') AS bad_date_mutation FROM lineitem",
)
def malformed_counted(spark, sf):
    """Values that cannot be read are counted per column."""
    raw = t.table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "n/a").otherwise(F.col("l_extendedprice").cast("string")).alias("valeur_fonciere"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity").cast("string")).alias("surface_reelle_bati"),
        F.when(F.col("l_linenumber") > 6, "many").otherwise(F.col("l_linenumber").cast("string")).alias("nombre_pieces_principales"),
        F.when(F.col("l_linestatus") == "F", "31.12.1999").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date_mutation"),
    )
    return silver.sale_rejects(raw)


@query("number_or_null", "SELECT event_id, CASE WHEN event_type <> 'click' AND event_type <> 'view' THEN value END AS number FROM events")
def number_or_null(spark, sf):
    kind = F.col("event_type")
    text = F.when(kind == "click", "NaN").when(kind == "view", "-").otherwise(F.col("value").cast("string"))
    return t.table(spark, sf, "events").select("event_id", parsing.number_or_null(text).alias("number"))


@query("iso_stamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS stamp FROM events")
def iso_stamp(spark, sf):
    return t.table(spark, sf, "events").select("event_id", parsing.iso_utc(F.col("ts").cast("timestamp")).alias("stamp"))


# ---- codes, arithmetic, classes ----------------------------------------------------------


@query(
    "codes_and_districts",
    f"SELECT c_custkey, {code('c_nationkey + 1')} AS code, CAST(c_nationkey + 1 AS SMALLINT) AS district, CAST(c_nationkey + 1 AS SMALLINT) AS zone_district FROM customer",
)
def codes_and_districts(spark, sf):
    rows = t.table(spark, sf, "customer").select("c_custkey", codes.code_of_district(F.col("c_nationkey") + 1).alias("code"))
    zone = F.concat("code", F.lit("0101"))
    return rows.select(
        "c_custkey", "code", codes.district_of_code("code").alias("district"), codes.district_of_zone(zone).alias("zone_district")
    )


@query(
    "guarded_ratio",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN {half_up('l_tax / l_discount', 2)} END AS rate,
    CAST(CASE WHEN l_tax <> 0 THEN {half_up('l_extendedprice / l_tax', 0)} END AS INTEGER) AS density FROM lineitem""",
)
def guarded_ratio(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.ratio(F.col("l_tax"), F.col("l_discount"), 2).alias("rate"),
        numbers.ratio(F.col("l_extendedprice"), F.col("l_tax"), 0).cast("int").alias("density"),
    )


@query(
    "sum_without_nulls",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 5 END, 0)
    + coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderkey % 3 END, 0) AS total FROM orders""",
)
def sum_without_nulls(spark, sf):
    key = F.col("o_orderkey")
    a, b = F.when(F.col("o_orderpriority") != "5-LOW", key % 5), F.when(F.col("o_orderstatus") != "F", key % 3)
    return t.table(spark, sf, "orders").select("o_orderkey", numbers.sum_of(a, b).alias("total"))


@query("square_kilometres", f"SELECT o_orderkey, {half_up('o_totalprice / 1000000', 3)} AS km2 FROM orders")
def square_kilometres(spark, sf):
    return t.table(spark, sf, "orders").select("o_orderkey", numbers.km2(F.col("o_totalprice")).alias("km2"))


@query(
    "room_classes",
    """SELECT cls AS room_class, count(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'R' OR l_linenumber <= 1 THEN 'studio_t1' WHEN l_linenumber = 2 THEN 't2'
    WHEN l_linenumber = 3 THEN 't3' WHEN l_linenumber = 4 THEN 't4' ELSE 't5_plus' END AS cls FROM lineitem) GROUP BY 1""",
)
def room_classes(spark, sf):
    rooms = F.when(F.col("l_returnflag") != "R", F.col("l_linenumber").cast("string"))
    rows = t.table(spark, sf, "lineitem").select(classes.room_class(rooms).alias("room_class"))
    return rows.groupBy("room_class").agg(F.count("*").alias("n"))


@query(
    "surface_classes",
    """SELECT l_orderkey, s AS surface, CASE WHEN s < 20 THEN 'lt_20' WHEN s < 40 THEN 'bt_20_40' WHEN s < 60 THEN 'bt_40_60' WHEN s < 80 THEN 'bt_60_80'
    WHEN s < 120 THEN 'bt_80_120' WHEN s >= 120 THEN 'gt_120' END AS surface_class
    FROM (SELECT l_orderkey, CASE WHEN l_returnflag <> 'A' THEN l_quantity * 4 END AS s FROM lineitem)""",
)
def surface_classes(spark, sf):
    surface = F.when(F.col("l_returnflag") != "A", F.col("l_quantity") * 4)
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", surface.alias("surface"), classes.surface_class(surface).alias("surface_class")
    )


@query(
    "price_steps",
    "SELECT l_orderkey, CAST(CASE WHEN l_extendedprice >= 13000 THEN 3 WHEN l_extendedprice >= 11000 THEN 2 WHEN l_extendedprice >= 9000 THEN 1 ELSE 0 END AS INTEGER) AS step FROM lineitem",
)
def price_steps(spark, sf):
    return t.table(spark, sf, "lineitem").select("l_orderkey", classes.price_step(F.col("l_extendedprice")).alias("step"))


@query(
    "labels_with_default",
    f"""SELECT c_custkey, CASE WHEN c_nationkey + 1 > 20 THEN 'Arr. ' || (c_nationkey + 1)
    ELSE CASE WHEN c_nationkey = 0 THEN '1er' ELSE (c_nationkey + 1) || 'ème' END || ' arr. - ' ||
    {QUARTERS}[c_nationkey + 1] END AS nom
    FROM customer""",
)
def labels_with_default(spark, sf):
    rows = t.table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") + 1).cast("smallint").alias("arrondissement"))
    return with_label(rows, district_labels(spark)).select("c_custkey", "nom")


@query(
    "air_document_labels",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE "
    + f"{AIR_LABEL_SQL}[event_id % 6 + 1] END AS air_label FROM events",
)
def air_document_labels(spark, sf):
    return _air_documents(spark, sf).select("event_id", document_label(F.col("document")).alias("air_label"))


@query("air_stored_labels", SQL["air_document_labels"])
def air_stored_labels(spark, sf):
    """The same documents stored as variants: parsed when they are written, not when they are read."""
    stored = staged(_air_documents(spark, sf).select("event_id", F.try_parse_json("document").alias("document")), "air")
    return stored.select("event_id", variant_label(F.col("document")).alias("air_label"))


def _air_documents(spark, sf):
    """Documents of five shapes: list with label, map with index, top-level text, object, none."""
    rows = t.table(spark, sf, "events").select(
        "event_id", "event_type", F.get(F.array(*[F.lit(x) for x in t.AIR_LABELS]), (F.col("event_id") % 6).cast("int")).alias("l")
    )
    shapes = {
        "click": F.to_json(F.struct(F.array(F.struct(F.col("l").alias("label"))).alias("data"))),
        "error": F.to_json(F.struct(F.create_map(F.lit("75101"), F.array(F.struct(F.col("l").alias("indice")))).alias("data"))),
        "purchase": F.to_json(F.struct(F.col("l").alias("today"))),
        "signup": F.to_json(F.struct(F.struct(F.col("l").alias("qualif")).alias("indice"))),
    }
    document = F.lit('{"data": []}')
    for kind, shape in shapes.items():
        document = F.when(F.col("event_type") == kind, shape).otherwise(document)
    return rows.select("event_id", document.alias("document"))


@query(
    "air_severity",
    f"""SELECT event_id, CAST(event_id % 6 + 1 AS INTEGER) AS severity, CASE WHEN event_id % 6 > user_id % 6 THEN 'no2'
    WHEN event_id % 6 < user_id % 6 THEN 'o3' ELSE 'no2,o3' END AS worst FROM events""",
)
def air_severity(spark, sf):
    labels = F.array(*[F.lit(x) for x in t.AIR_LABELS])
    rows = t.table(spark, sf, "events").select(
        "event_id",
        F.get(labels, (F.col("event_id") % 6).cast("int")).alias("no2"),
        F.get(labels, (F.col("user_id") % 6).cast("int")).alias("o3"),
    )
    return rows.select(
        "event_id", severity(F.col("no2")).alias("severity"), worst_pollutants({"no2": F.col("no2"), "o3": F.col("o3")}).alias("worst")
    )
