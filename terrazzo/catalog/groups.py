"""Aggregations, joins and window calculations."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrazzo.catalog import tables as t
from terrazzo.catalog.layers import AREAS
from terrazzo.catalog.registry import query
from terrazzo.catalog.sqltext import (
    CRIME, DIM, G_HOUSING, HOUSING, PRICED, RAW_SALES, ROOM_SHARES, SALES, SURFACE_SHARES, change, exact_avg, exact_sum, half_up,
)
from terrazzo.functions.classes import room_flags, surface_flags
from terrazzo.functions.numbers import exact_avg as spark_exact_avg
from terrazzo.functions.numbers import share_of
from terrazzo.operators import aggregates, joins, windows
from terrazzo.operators.exact import exact_totals, mean_of
from terrazzo.operators.quantiles import exact_quantiles
from terrazzo.plans import bronze, silver

KEYS = ["arrondissement", "annee"]

# ---- aggregations ------------------------------------------------------------------------


@query("agg_count", f"WITH {SALES} SELECT arrondissement, annee, count(*) AS nb_transactions FROM sales GROUP BY ALL")
def agg_count(spark, sf):
    return t.sales(spark, sf).groupBy(*KEYS).agg(aggregates.sale_measures()["nb_transactions"].alias("nb_transactions"))


@query(
    "agg_quantiles",
    "SELECT l_returnflag, l_linestatus, quantile_disc(l_extendedprice, 0.1) AS p10, quantile_disc(l_extendedprice, 0.5) AS p50, "
    "quantile_disc(l_extendedprice, 0.9) AS p90, quantile_disc(l_quantity, 0.5) AS q50 FROM lineitem GROUP BY ALL",
)
def agg_quantiles(spark, sf):
    """Exact quantiles of six groups, each a sixth of all line items."""
    wanted = {
        "p10": ("l_extendedprice", 0.1), "p50": ("l_extendedprice", 0.5), "p90": ("l_extendedprice", 0.9), "q50": ("l_quantity", 0.5),
    }
    return exact_quantiles(t.table(spark, sf, "lineitem"), ("l_returnflag", "l_linestatus"), wanted)


@query(
    "agg_quantiles_signed",
    "SELECT c_mktsegment, quantile_disc(c_acctbal - 5000, 0.25) AS q1, quantile_disc(c_acctbal - 5000, 0.75) AS q3 FROM customer GROUP BY ALL",
)
def agg_quantiles_signed(spark, sf):
    rows = t.table(spark, sf, "customer").select("c_mktsegment", (F.col("c_acctbal") - 5000).alias("v"))
    return exact_quantiles(rows, ("c_mktsegment",), {"q1": ("v", 0.25), "q3": ("v", 0.75)})


@query(
    "agg_quantiles_small",
    "SELECT c_mktsegment, quantile_disc(abs(c_acctbal) / 1e8::DOUBLE, 0.25) AS q1, quantile_disc(abs(c_acctbal) / 1e8::DOUBLE, 0.75) AS q3 FROM customer GROUP BY ALL",
)
def agg_quantiles_small(spark, sf):
    """Shares below a thousandth."""
    rows = t.table(spark, sf, "customer").select("c_mktsegment", (F.abs("c_acctbal") / 1e8).alias("v"))
    return exact_quantiles(rows, ("c_mktsegment",), {"q1": ("v", 0.25), "q3": ("v", 0.75)})


# exact for these values: decimals of 30 and of 12 places
_TINY = "abs(c_acctbal) / 1e10::DOUBLE"
_LARGE = "abs(c_acctbal) * (c_custkey + 1) * 1e6::DOUBLE"


def _exact(expression: str, places: int) -> str:
    return f"CAST(sum(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,{places}))) AS DOUBLE)"


@query(
    "agg_sums_wide",
    f"SELECT c_nationkey, {_exact(_TINY, 30)} / count(*) AS small_mean, {_exact(_LARGE, 12)} AS large_sum, "
    f"{half_up(exact_sum('abs(c_acctbal) * ((c_custkey + 1) * 1000000)') + ' / CAST(sum((c_custkey + 1) * 1000000) AS DOUBLE)', 2)} AS weighted FROM customer GROUP BY 1",
)
def agg_sums_wide(spark, sf):
    """Means near 10^-7 and sums of prices with weights far above 10^13."""
    balance, key = F.abs("c_acctbal"), F.col("c_custkey") + 1
    rows = t.table(spark, sf, "customer")
    sums = exact_totals(rows, ["c_nationkey"], {"small": balance / 1e10, "large_sum": balance * key * 1e6})
    weighted = aggregates.means(rows, ["c_nationkey"], weighted={"weighted": (balance, key * 1000000)})
    return sums.select("c_nationkey", mean_of("small").alias("small_mean"), "large_sum").join(weighted, "c_nationkey")


# some balances become one of these
_SPECIAL = "CASE c_custkey % 35 WHEN 0 THEN {nan} WHEN 7 THEN 4e-13 WHEN 14 THEN 1e27 WHEN 21 THEN -1e27 WHEN 28 THEN 1e-300 ELSE c_acctbal END"


@query(
    "agg_sums_special",
    f"""WITH special AS (SELECT c_nationkey, c_custkey, CAST({_SPECIAL.format(nan="'nan'::DOUBLE")} AS DOUBLE) AS v FROM customer), kinds AS (
      SELECT c_nationkey, count(*) FILTER (NOT isnan(v)) AS numbers, count(*) FILTER (v = 1e27) - count(*) FILTER (v = -1e27) AS huge,
        count(*) FILTER (v = 4e-13) AS tiny, count(*) FILTER (c_custkey % 11 = 0) AS up, count(*) FILTER (c_custkey % 13 = 0 AND c_custkey % 11 <> 0) AS down,
        CAST(sum(CASE WHEN abs(v) < 1e7 THEN CAST(CAST(v AS VARCHAR) AS DECIMAL(38,14)) END) AS DOUBLE) AS small FROM special GROUP BY 1)
    SELECT c_nationkey, numbers, CAST(CAST(huge AS VARCHAR) || 'e27' AS DOUBLE) AS huge, CAST(CAST(4 * tiny AS VARCHAR) || 'e-13' AS DOUBLE) AS tiny,
      small AS cancelled, CASE WHEN up > 0 AND down > 0 THEN 'nan'::DOUBLE WHEN up > 0 THEN 'inf'::DOUBLE WHEN down > 0 THEN '-inf'::DOUBLE
      ELSE small END AS with_infinities FROM kinds""",
)
def agg_sums_special(spark, sf):
    """NaN is left out, infinities stay, 4e-13 and 1e27 count in full, and 1e27 leaves nothing behind where it is taken away again."""
    key, infinity = F.col("c_custkey"), float("inf")
    rows = t.table(spark, sf, "customer").withColumn("v", F.expr(_SPECIAL.format(nan="double('NaN')")).cast("double"))
    small = F.when(F.abs("v") < 1e7, F.col("v"))
    sums = {
        "all": F.col("v"),
        "huge": F.when(F.abs("v") > 1e7, F.col("v")).otherwise(0.0),
        "tiny": F.when(F.col("v") == 4e-13, F.col("v")).otherwise(0.0),
        "with_infinities": F.when(key % 11 == 0, infinity).when(key % 13 == 0, -infinity).otherwise(small),
    }
    totals = exact_totals(rows, ["c_nationkey"], sums).withColumnRenamed("all_count", "numbers")
    thrice = rows.select("c_nationkey", F.explode(F.array(small, F.lit(1e27), F.lit(-1e27))).alias("v"))
    cancelled = exact_totals(thrice, ["c_nationkey"], {"cancelled": F.col("v")})
    return totals.join(cancelled, "c_nationkey").select("c_nationkey", "numbers", "huge", "tiny", "cancelled", "with_infinities")


@query("agg_mean", f"WITH {SALES} SELECT arrondissement, annee, {half_up(exact_avg('prix_m2'), 2)} AS prix_m2_moyen FROM sales GROUP BY 1, 2")
def agg_mean(spark, sf):
    return t.sales(spark, sf).groupBy(*KEYS).agg(F.round(spark_exact_avg(F.col("prix_m2")), 2).alias("prix_m2_moyen"))


@query("agg_room_shares", f"WITH {SALES} SELECT arrondissement, annee, {ROOM_SHARES} FROM sales GROUP BY 1, 2")
def agg_room_shares(spark, sf):
    flags = room_flags(F.col("nombre_pieces_principales"))
    return t.sales(spark, sf).groupBy(*KEYS).agg(*[share_of(f).alias(n) for n, f in flags.items()])


@query("agg_surface_shares", f"WITH {SALES} SELECT arrondissement, annee, {SURFACE_SHARES} FROM sales GROUP BY 1, 2")
def agg_surface_shares(spark, sf):
    flags = surface_flags(F.col("surface_reelle_bati"))
    return t.sales(spark, sf).groupBy(*KEYS).agg(*[share_of(f).alias(n) for n, f in flags.items()])


@query(
    "agg_category_share",
    f"WITH {RAW_SALES}, {PRICED} SELECT arrondissement, annee, "
    + half_up("nullif(CAST(count(*) FILTER (type_local = 'Maison' AND annee > 1996) AS DOUBLE), 0) / count(*) * 100", 2)
    + " AS part_maisons FROM all_sales GROUP BY 1, 2",
)
def agg_category_share(spark, sf):
    """Share of houses from 1997 on; null for the earlier years."""
    rows = silver.sales(t.raw_sales(spark, sf), kind=None)
    return aggregates.category_share(rows, tuple(KEYS), (F.col("type_local") == "Maison") & (F.col("annee") > 1996), "part_maisons")


@query(
    "agg_multi_sum",
    f"WITH {HOUSING} SELECT mode_real, CAST(sum(nb_logmt_total) AS BIGINT) AS nb_logements_sociaux, CAST(sum(nb_plai) AS BIGINT) AS nb_plai, "
    "CAST(sum(nb_plus) AS BIGINT) AS nb_plus_pluscd, CAST(sum(nb_pls) AS BIGINT) AS nb_pls FROM housing GROUP BY 1",
)
def agg_multi_sum(spark, sf):
    return aggregates.housing_totals(t.housing(spark, sf), ("mode_real",))


@query(
    "agg_label_pivot",
    f"WITH {CRIME} SELECT arrondissement, CAST(sum(nombre) AS BIGINT) AS taux_delinquance_global, {half_up(exact_sum('taux_pour_mille'), 1)} AS taux_delinquance_pmille, "
    f"{exact_sum('CASE WHEN starts_with(indicateur, ' + chr(39) + 'CLICK' + chr(39) + ') THEN taux_pour_mille END')} AS taux_cambriolages_pmille, "
    f"{exact_sum('CASE WHEN indicateur IN (' + chr(39) + 'click' + chr(39) + ', ' + chr(39) + 'view' + chr(39) + ') THEN taux_pour_mille END')} AS taux_violences_pmille "
    "FROM crime GROUP BY 1",
)
def agg_label_pivot(spark, sf):
    """A term in the wrong case matches nothing and gives null."""
    return aggregates.crime_rates(t.crime(spark, sf), ("arrondissement",), burglary=["CLICK"], violence=["click", "view"])


@query(
    "agg_label_pivot_any_case",
    f"WITH {CRIME} SELECT arrondissement, {exact_sum('CASE WHEN indicateur = ' + chr(39) + 'click' + chr(39) + ' THEN taux_pour_mille END')} AS taux_cambriolages_pmille FROM crime GROUP BY 1",
)
def agg_label_pivot_any_case(spark, sf):
    rates = aggregates.crime_rates(t.crime(spark, sf), ("arrondissement",), burglary=["CLICK"], ignore_case=True)
    return rates.select("arrondissement", "taux_cambriolages_pmille")


@query(
    "agg_housing_quality",
    f"WITH {HOUSING} SELECT count(*) AS n_rows, min(nb_pls) AS nb_pls_min, max(nb_pls) AS nb_pls_max, {half_up('avg(nb_pls)', 6)} AS nb_pls_avg, "
    "count(DISTINCT mode_real) AS mode_real_distinct, CAST(sum(nb_logmt_total) AS BIGINT) AS nb_logmt_total_total FROM housing",
)
def agg_housing_quality(spark, sf):
    figures = aggregates.profile(t.housing(spark, sf), "nb_pls", distinct=["mode_real"], total=["nb_logmt_total"])
    return figures.withColumn("nb_pls_avg", F.round("nb_pls_avg", 6))


@query(
    "agg_running_total",
    f"WITH {HOUSING}, {G_HOUSING} SELECT arrondissement, annee, CAST(sum(nb_plai) OVER (PARTITION BY arrondissement ORDER BY annee) AS BIGINT) AS cumul FROM g_housing",
)
def agg_running_total(spark, sf):
    rows = aggregates.housing_totals(t.housing(spark, sf)).withColumn("annee", F.col("annee").cast("int"))
    return rows.select(*KEYS, windows.running_total("nb_plai").alias("cumul"))


@query(
    "agg_all_years_total",
    f"WITH {HOUSING}, {G_HOUSING} SELECT arrondissement, annee, CAST(sum(nb_pls) OVER (PARTITION BY arrondissement) AS BIGINT) AS total FROM g_housing",
)
def agg_all_years_total(spark, sf):
    rows = aggregates.housing_totals(t.housing(spark, sf)).withColumn("annee", F.col("annee").cast("int"))
    return rows.select(*KEYS, windows.all_years_total("nb_pls").alias("total"))


_W = "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 0 ELSE c_custkey % 50 END"
_V = "CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END"


@query(
    "agg_weighted_mean",
    f"""SELECT c_nationkey, {half_up(exact_sum('v * w') + ' / CAST(sum(CASE WHEN v IS NOT NULL THEN w END) AS DOUBLE)', 2)} AS mean,
    {half_up(exact_avg('v'), 2)} AS plain FROM
    (SELECT c_nationkey, {_V} AS v, coalesce(nullif({_W}, 0), 1) AS w FROM customer) GROUP BY 1""",
)
def agg_weighted_mean(spark, sf):
    """Null and zero weights count as one, null values are left out."""
    key = F.col("c_custkey")
    rows = t.table(spark, sf, "customer").select(
        "c_nationkey",
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal")).alias("v"),
        F.when(key % 3 == 1, 0).when(key % 3 == 2, key % 50).alias("w"),
    )
    return aggregates.means(rows, ["c_nationkey"], weighted={"mean": (F.col("v"), F.col("w"))}, simple={"plain": F.col("v")})



@query(
    "agg_total_or_rows",
    "SELECT event_type, coalesce(nullif(CAST(sum(CASE WHEN event_type <> 'view' THEN event_id % 2 ELSE 0 END) AS BIGINT), 0), count(*)) AS total FROM events GROUP BY 1",
)
def agg_total_or_rows(spark, sf):
    amount = F.when(F.col("event_type") != "view", F.col("event_id") % 2).otherwise(0)
    return t.table(spark, sf, "events").groupBy("event_type").agg(aggregates.total_or_rows(amount).alias("total"))


# ---- joins -------------------------------------------------------------------------------


@query(
    "join_area_population",
    f"WITH {AREAS} SELECT * FROM areas",
)
def join_area_population(spark, sf):
    return bronze.areas(t.raw_areas(spark, sf), t.people(spark, sf))


@query(
    "join_two_keys",
    f"WITH {SALES}, {HOUSING} SELECT s.arrondissement, s.annee, s.n AS n_sales, h.n AS n_programmes FROM "
    "(SELECT arrondissement, annee, count(*) AS n FROM sales GROUP BY ALL) s LEFT JOIN "
    "(SELECT arrondissement, CAST(annee AS INTEGER) AS annee, count(*) AS n FROM housing GROUP BY 1, 2) h USING (arrondissement, annee)",
)
def join_two_keys(spark, sf):
    sold = t.sales(spark, sf).groupBy(*KEYS).agg(F.count("*").alias("n_sales"))
    built = t.housing(spark, sf).groupBy(*KEYS).agg(F.count("*").alias("n_programmes"))
    return sold.join(built, KEYS, "left")


@query(
    "join_dimension",
    f"WITH {DIM}, {HOUSING}, {G_HOUSING} SELECT arrondissement, annee, nb_pls, nom, code_postal FROM g_housing JOIN dim USING (arrondissement)",
)
def join_dimension(spark, sf):
    fact = aggregates.housing_totals(t.housing(spark, sf)).select("arrondissement", F.col("annee").cast("int").alias("annee"), "nb_pls")
    return joins.with_dimension(fact, t.dimension(spark, sf), ["nom", "code_postal"])


_GAPPY = f"WITH {HOUSING}, {G_HOUSING}, fact AS (SELECT * REPLACE (CAST(annee + CASE WHEN annee >= 1997 AND arrondissement > 10 THEN 1 ELSE 0 END AS INTEGER) AS annee) FROM g_housing)"


def _gappy_fact(spark, sf):
    """Housing totals with a gap: the later districts have no 1997, theirs count for the year after from then on."""
    late = (F.col("annee") >= 1997) & (F.col("arrondissement") > 10)
    rows = t.housing(spark, sf).withColumn("annee", F.col("annee").cast("int") + F.when(late, 1).otherwise(0))
    return aggregates.housing_totals(rows)


@query(
    "join_previous_year",
    f"{_GAPPY} SELECT g.arrondissement, g.annee, g.nb_pls, p.nb_pls AS prev_nb_pls FROM fact g LEFT JOIN fact p "
    "ON g.arrondissement = p.arrondissement AND p.annee = g.annee - 1",
)
def join_previous_year(spark, sf):
    return joins.with_previous_year(_gappy_fact(spark, sf).select(*KEYS, "nb_pls"), "nb_pls")


@query(
    "join_total_until",
    f"{_GAPPY} SELECT arrondissement, annee, nb_pls, total_nb_pls FROM fact LEFT JOIN "
    "(SELECT arrondissement, CAST(sum(coalesce(nb_pls, 0)) AS BIGINT) AS total_nb_pls FROM fact WHERE annee <= 1998 GROUP BY 1) USING (arrondissement)",
)
def join_total_until(spark, sf):
    return joins.with_total_until(_gappy_fact(spark, sf).select(*KEYS, "nb_pls"), "nb_pls", until=1998)


# ---- windows, sorts, limits --------------------------------------------------------------


@query(
    "window_yearly_change",
    f"{_GAPPY} SELECT g.arrondissement, g.annee, {change('CAST(g.nb_pls AS DOUBLE)', 'p.nb_pls')} AS variation FROM fact g LEFT JOIN fact p "
    "ON g.arrondissement = p.arrondissement AND p.annee = g.annee - 1",
)
def window_yearly_change(spark, sf):
    """Null where the year before is missing."""
    return _gappy_fact(spark, sf).select(*KEYS, windows.yearly_change("nb_pls").alias("variation"))


_YEARLY = "yearly AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)"


def _yearly(spark, sf):
    return t.table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "window_min_max",
    f"WITH {_YEARLY} SELECT year, o_orderpriority, CAST(n - min(n) OVER p AS DOUBLE) / CASE WHEN max(n) OVER p = min(n) OVER p THEN 1 ELSE max(n) OVER p - min(n) OVER p END AS scaled "
    "FROM yearly WINDOW p AS (PARTITION BY o_orderpriority)",
)
def window_min_max(spark, sf):
    return _yearly(spark, sf).select("year", "o_orderpriority", windows.min_max_scaled("n", "o_orderpriority").alias("scaled"))


@query(
    "window_share_of_total",
    f"WITH {_YEARLY}, d AS (SELECT year, o_orderpriority, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE n END AS n FROM yearly) "
    "SELECT year, o_orderpriority, CASE WHEN n > 0 THEN CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY year) END AS share FROM d",
)
def window_share_of_total(spark, sf):
    rows = _yearly(spark, sf).withColumn("n", F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(F.col("n")))
    return rows.select("year", "o_orderpriority", windows.share_of_total("n", "year").alias("share"))


@query(
    "window_bar_scaled",
    f"WITH {_YEARLY} SELECT year, o_orderpriority, CAST(n AS DOUBLE) / greatest(max(n) OVER (PARTITION BY year), 1) AS bar FROM yearly",
)
def window_bar_scaled(spark, sf):
    return _yearly(spark, sf).select("year", "o_orderpriority", windows.bar_scaled("n", "year").alias("bar"))


_METRICS = ["nb_logements_sociaux", "nb_plai", "nb_plus_pluscd", "nb_pls"]


@query(
    "window_compared",
    f"WITH {HOUSING}, h AS (SELECT * FROM housing), m AS ("
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, coalesce(sum({c}) FILTER (arrondissement = 3), 0)::DOUBLE AS value_a, coalesce(sum({c}) FILTER (arrondissement = 12), 0)::DOUBLE AS value_b FROM h"
        for m, c in zip(_METRICS, ["nb_logmt_total", "nb_plai", "nb_plus", "nb_pls"])
    )
    + ") SELECT *, value_a / greatest(1, value_a, value_b) AS scaled_a, value_b / greatest(1, value_a, value_b) AS scaled_b FROM m",
)
def window_compared(spark, sf):
    fact = aggregates.housing_totals(t.housing(spark, sf), ("arrondissement",))
    return windows.compared(fact, "arrondissement", 3, 12, _METRICS)


@query("sorted_by_key", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey")
def sorted_by_key(spark, sf):
    return t.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return t.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "union_of_sources",
    "SELECT kind, count(*) AS n, min(balance) AS lowest FROM (SELECT 'customer' AS kind, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT 'supplier', s_acctbal FROM supplier) GROUP BY 1",
)
def union_of_sources(spark, sf):
    customers = t.table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"))
    suppliers = t.table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    return customers.unionByName(suppliers).groupBy("kind").agg(F.count("*").alias("n"), F.min("balance").alias("lowest"))
