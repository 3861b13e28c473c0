"""Contract checks, the run log and the jobs end to end."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.catalog import ingest
from terrazzo.catalog import tables as t
from terrazzo.catalog.registry import query
from terrazzo.catalog.sqltext import HOUSING, gold, half_up
from terrazzo.errors import IngestionError
from terrazzo.operators import contracts
from terrazzo.plans import bronze, jobs, runs
from terrazzo.schemas import RUN_STATUSES, struct
from terrazzo.session import staging_path
from terrazzo.sources import sinks


@query(
    "contract_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def contract_duplicate_keys(spark, sf):
    return contracts.duplicate_keys(t.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "contract_orphans",
    "SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_nationkey + 1 END AS arrondissement FROM customer "
    "WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey >= 20",
)
def contract_orphans(spark, sf):
    """Customers of unknown districts; those without a district are not orphans."""
    district = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_nationkey") + 1)
    rows = t.table(spark, sf, "customer").select("c_custkey", district.alias("arrondissement"))
    return contracts.orphans(rows, t.dimension(spark, sf), "arrondissement", "arrondissement")


@query(
    "contract_rules",
    """SELECT 'balance is null' AS rule, count(*) FILTER (c_acctbal < 1000) AS n_broken FROM customer
    UNION ALL SELECT 'c_mktsegment unknown', count(*) FILTER (c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY')) FROM customer
    UNION ALL SELECT 'c_custkey too wide', count(*) FILTER (c_custkey > 999) FROM customer
    UNION ALL SELECT 'c_acctbal too wide', count(*) FILTER (abs(c_acctbal) >= 999.995) FROM customer
    UNION ALL SELECT 'c_mktsegment too long', count(*) FILTER (length(c_mktsegment) > 8) FROM customer""",
)
def contract_rules(spark, sf):
    rows = t.table(spark, sf, "customer").withColumn("balance", F.when(F.col("c_acctbal") >= 1000, F.col("c_acctbal")))
    declared = struct(
        ("c_custkey", T.DecimalType(3, 0)), ("c_acctbal", T.DecimalType(5, 2)), ("c_mktsegment", T.StringType())
    )
    rules = (
        contracts.not_null("balance")
        | contracts.one_of("c_mktsegment", ["HOUSEHOLD", "MACHINERY"])
        | contracts.fits_schema(declared, {"c_mktsegment": 8})
    )
    return contracts.violations(rows, rules)


@query("contract_status_values", "SELECT 'statut unknown' AS rule, count(*) FILTER (event_type NOT IN ('error', 'view')) AS n_broken FROM events")
def contract_status_values(spark, sf):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "success").otherwise("odd")
    rows = t.table(spark, sf, "events").select(status.alias("statut"))
    return contracts.violations(rows, contracts.one_of("statut", list(RUN_STATUSES)))


@query(
    "contract_evolved",
    "SELECT CAST(c_nationkey AS SMALLINT) AS c_nationkey, c_name, CAST(NULL AS DOUBLE) AS superficie, CAST(2018 AS SMALLINT) AS annee_ref FROM customer",
)
def contract_evolved(spark, sf):
    """Cast, reorder, add a missing column and one with a default."""
    declared = struct(
        ("c_nationkey", T.ShortType()), ("c_name", T.StringType()), ("superficie", T.DoubleType()), ("annee_ref", T.ShortType())
    )
    return contracts.evolved(t.table(spark, sf, "customer"), declared, {"annee_ref": 2018})


@query(
    "contract_misfits",
    """SELECT 'c_custkey too wide' AS rule, count(*) FILTER (c_custkey > 99) AS n_broken FROM customer
    UNION ALL SELECT 'c_acctbal too wide', count(*) FILTER (abs(c_acctbal) >= 99.995) FROM customer""",
)
def contract_misfits(spark, sf):
    """What would not fit, counted before a lenient cast."""
    declared = struct(("c_custkey", T.DecimalType(2, 0)), ("c_acctbal", T.DecimalType(4, 2)), ("missing", T.DoubleType()))
    return contracts.misfits(t.table(spark, sf, "customer"), declared)


@query(
    "run_report",
    """SELECT o_orderpriority AS pipeline_name, count(*) AS n_runs,
    CAST(round(CAST(CAST(CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) * 100 AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE) AS success_rate,
    quantile_disc(o_totalprice, 0.5) AS duration_p50 FROM orders GROUP BY 1""",
)
def run_report(spark, sf):
    """Orders stand in for runs."""
    log = t.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("pipeline_name"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("statut"),
        F.col("o_totalprice").alias("duration_s"),
    )
    return runs.run_report(log)


#: deliveries that are landed, fed or refined side by side: the tasks of one fill the cores that the last ones of another leave idle
AT_ONCE = 4


def _raised(failed: dict[str, Exception]) -> None:
    for error in failed.values():
        raise error


def _landed(spark, sf) -> str:
    """The six batch deliveries in one landing folder; no air delivery that day."""
    folder = ingest._sales_files(spark, sf)
    arrays = t.json_arrays(t.raw_housing(spark, sf), "adresse_programme")
    writes = {
        "logements_sociaux": lambda: arrays.write.option("maxRecordsPerFile", 1).text(f"{folder}/{bronze.HOUSING_FILE}"),
        "delinquance": lambda: t.raw_crime(spark, sf).write.parquet(f"{folder}/{bronze.CRIME_FILE}"),
        "revenus": lambda: sinks.write_csv(t.raw_incomes(spark, sf), f"{folder}/{bronze.INCOMES_FILE}"),
        "arrondissements": lambda: sinks.write_csv(t.raw_areas(spark, sf), f"{folder}/{bronze.DISTRICTS_FILE}", sep=";"),
        "residences_principales": lambda: sinks.write_csv(t.raw_residences(spark, sf), f"{folder}/{bronze.RESIDENCES_FILE}", sep=";"),
    }
    _raised(jobs.side_by_side(spark, list(writes), lambda source: writes[source](), AT_ONCE))
    return folder


SOURCES = [s for s in bronze.FEEDS if s != "airparif"]


def _built(spark, sf, log: str | None = None) -> str:
    """Deliveries through bronze to silver; returns the silver root."""
    folder, root = _landed(spark, sf), staging_path(spark, "layers")
    jobs.run_bronze(spark, list(bronze.FEEDS), folder, f"{root}/bronze", ingest.DATE, log, AT_ONCE)
    jobs.run_silver(spark, SOURCES, f"{root}/bronze", f"{root}/silver", ingest.DATE, log, AT_ONCE)
    return f"{root}/silver"


@query(
    "layers_end_to_end",
    f"WITH {gold('housing', 'crime', 'incomes')} SELECT * REPLACE (CAST(annee AS SMALLINT) AS annee, "
    f"{half_up('taux_cambriolages_pmille', 3)} AS taux_cambriolages_pmille, {half_up('taux_violences_pmille', 3)} AS taux_violences_pmille), "
    "CAST(NULL AS DOUBLE) AS taux_logements_sociaux FROM gold",
)
def layers_end_to_end(spark, sf):
    """Raw files to the gold table by the jobs, in its declared types (decimals shown as doubles)."""
    fact = jobs.build_gold(spark, _built(spark, sf), burglary=t.BURGLARY, violence=t.VIOLENCE)
    wanted = [c for c in fact.columns if c != "computed_at"]
    return fact.select(*[F.col(c).cast("double") if fact.schema[c].dataType.typeName() == "decimal" else F.col(c) for c in wanted])


@query(
    "run_log",
    f"""WITH {HOUSING} SELECT 'bronze_logements_sociaux' AS pipeline_name, 'success' AS statut, CAST(NULL AS BIGINT) AS nb_lignes_in, count(*) AS nb_lignes_out,
    true AS timed FROM orders
    UNION ALL SELECT 'silver_logements_sociaux', 'success', (SELECT count(*) FROM orders), count(*), true FROM housing
    UNION ALL SELECT 'bronze_airparif', 'skipped', NULL, NULL, true
    UNION ALL SELECT 'bronze_dvf', 'failed', NULL, NULL, true""",
)
def run_log(spark, sf):
    """Rows counted while they are written; a skipped and a failed delivery are logged too."""
    folder, root = staging_path(spark, "landing"), staging_path(spark, "layers")
    arrays = t.json_arrays(t.raw_housing(spark, sf), "adresse_programme")
    arrays.write.option("maxRecordsPerFile", 1).text(f"{folder}/{bronze.HOUSING_FILE}")
    try:
        jobs.run_bronze(spark, ["dvf", "logements_sociaux", "airparif"], folder, f"{root}/bronze", ingest.DATE, f"{root}/runs")
    except IngestionError:
        pass
    jobs.run_silver(spark, ["logements_sociaux"], f"{root}/bronze", f"{root}/silver", ingest.DATE, f"{root}/runs")
    return runs.run_log(spark, f"{root}/runs").select(
        "pipeline_name", "statut", "nb_lignes_in", "nb_lignes_out", (F.col("duration_s") >= 0).alias("timed")
    )
