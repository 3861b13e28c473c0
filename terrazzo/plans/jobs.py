"""The three jobs: deliveries to bronze, bronze to silver, silver to gold.

    python -m terrazzo.plans.jobs bronze --source all --input-path in --output-path bronze --date 2026-06-24
    python -m terrazzo.plans.jobs silver --source all --bronze-path bronze --silver-path silver --date 2026-06-24
    python -m terrazzo.plans.jobs gold   --silver-path silver --jdbc-url jdbc:... [--annee 2024] [--write-mode append]
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.errors import ConfigurationError, IngestionError
from terrazzo.operators.aggregates import BURGLARY_TERMS, VIOLENCE_TERMS, distinct_figures, range_figures
from terrazzo.operators import sketches
from terrazzo.operators.contracts import enforced, evolved, not_null, one_of, unique
from terrazzo.operators.filters import matching
from terrazzo.plans import bronze, gold, increments, silver
from terrazzo.plans.runs import recorded
from terrazzo.schemas import GOLD, GOLD_KEY, INGESTION_DATE, SILVER
from terrazzo.session import build_session
from terrazzo.sources.files import read_ingestion, read_newest, required
from terrazzo.sources.sinks import update_jdbc, write_dated, write_jdbc


def feed(spark: SparkSession, source: str, folder: str, root: str, date: str, runs: str | None = None) -> None:
    """One delivery to bronze; a missing optional delivery is skipped."""
    with recorded(spark, runs, f"bronze_{source}", source, "bronze") as run:
        delivered = bronze.FEEDS[source](spark, folder, date)
        if delivered is None:
            run.skip()
        else:
            write_dated(run.writes(delivered), root, source, date)


def side_by_side(spark: SparkSession, sources: list[str], run: Callable[[str], None], at_once: int) -> dict[str, Exception]:
    """Run a job for every source, `at_once` of them together, each in a scheduler pool of its own; the errors by source, in the order given.

    With the fair scheduler (`spark.scheduler.mode`) a small source does not wait behind the tasks of a large one; the driver only waits.
    """  # noqa: E501

    def one(source: str) -> Exception | None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", source)
        try:
            run(source)
        except Exception as e:
            return e
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        return None

    if at_once < 1:
        raise ConfigurationError("at least one source runs at a time")
    with ThreadPoolExecutor(at_once) as threads:
        # each source has a copy of its own of the caller's local properties
        running = [threads.submit(inheritable_thread_target(spark)(partial(one, source))) for source in sources]
        found = [r.result() for r in running]
    return {source: e for source, e in zip(sources, found, strict=True) if e is not None}


def run_bronze(
    spark: SparkSession, sources: list[str], folder: str, root: str, date: str, runs: str | None = None, at_once: int = 1
) -> None:
    """Feed every source, `at_once` side by side; one that fails does not stop the others, but the job fails at the end."""
    failed = side_by_side(spark, sources, lambda source: feed(spark, source, folder, root, date, runs), at_once)
    if failed:
        raise IngestionError("; ".join(f"{source}: {e}" for source, e in failed.items()))


def refine(spark: SparkSession, source: str, bronze_root: str, silver_root: str, date: str, runs: str | None = None) -> None:
    """One bronze source to its silver table.

    The run log gets the malformed values of the sales, the range of the table's measure and about how many distinct values some columns hold, all
    counted by the pass that writes; that pass fails where a row is of no district.
    """
    table, step = silver.STEPS[source]
    with recorded(spark, runs, f"silver_{source}", source, "silver") as run:
        raw = required(lambda: read_ingestion(spark, bronze_root, source, date))
        counted = run.reads(raw, **(silver.sale_reject_counts(raw) if source == "dvf" else {}))
        refined = enforced(step(counted), not_null("arrondissement") | one_of("arrondissement", list(range(1, 21))))
        measure = silver.MEASURES.get(table)
        figures = range_figures(measure) if measure in refined.columns else {}
        figures |= distinct_figures(*[c for c in silver.DISTINCT.get(table, ()) if c in refined.columns])
        write_dated(run.writes(refined, **figures), silver_root, table, date)


def run_silver(
    spark: SparkSession, sources: list[str], bronze_root: str, silver_root: str, date: str, runs: str | None = None, at_once: int = 1
) -> None:
    """Refine the sources in turn, stopping at the first error; with more `at_once` they run side by side, and the first error is raised at the end."""
    if at_once == 1:
        for source in sources:
            refine(spark, source, bronze_root, silver_root, date, runs)
        return
    failed = side_by_side(spark, sources, lambda source: refine(spark, source, bronze_root, silver_root, date, runs), at_once)
    for error in failed.values():
        raise error


def silver_table(spark: SparkSession, root: str, table: str, date: str | None, year: int | None = None) -> DataFrame:
    """One ingestion date of a silver table, the newest by default, so that nothing is counted twice."""
    schema = SILVER[table]
    rows = required(lambda: read_ingestion(spark, root, table, date, schema) if date else read_newest(spark, root, table, schema))
    rows = rows.drop(*INGESTION_DATE)
    return matching(rows, annee=year) if "annee" in rows.columns else rows


def build_gold(
    spark: SparkSession,
    root: str,
    date: str | None = None,
    year: int | None = None,
    accuracy: int | None = None,
    **crime_options,
) -> DataFrame:
    """The gold table from the silver tables, in its declared types.

    The pass that writes it raises where a value does not fit its type or a district and year stand twice.
    `crime_options`: burglary, violence (terms looked for in the labels), ignore_case.
    """
    fact = gold.gold(
        *[silver_table(spark, root, name, date, year) for name in ("transactions", "logements_sociaux", "delinquance")],
        silver_table(spark, root, "revenus", date),
        accuracy=accuracy,
        **crime_options,
    )
    return unique(evolved(fact.withColumn("computed_at", F.current_timestamp()), GOLD), *GOLD_KEY)


def refresh_gold(spark: SparkSession, root: str, stored: DataFrame, before: str, date: str | None = None, **crime_options) -> DataFrame:
    """`stored`, the gold table of the ingestion date `before`, brought to a later date, the newest by default, in its declared types.

    Only districts and years whose silver rows differ between the two dates are computed again; the others keep their `computed_at`. To be written to
    another place than `stored` is read from. `crime_options` must be those of the stored table.
    """  # noqa: E501
    sources = {"sales": "transactions", "housing": "logements_sociaux", "crime": "delinquance", "incomes": "revenus"}
    old = {name: silver_table(spark, root, table, before) for name, table in sources.items()}
    new = {name: silver_table(spark, root, table, date) for name, table in sources.items()}
    touched = increments.touched_groups(increments.silver_prints(**old), increments.silver_prints(**new))
    fact = increments.refreshed_gold(stored, touched, **new, **crime_options)
    fact = fact.withColumn("computed_at", F.coalesce("computed_at", F.current_timestamp()))
    return unique(evolved(fact, GOLD), *GOLD_KEY)


def build_sketches(spark: SparkSession, root: str, date: str | None = None, year: int | None = None, size: int = sketches.SIZE) -> DataFrame:
    """Quantile sketches of the sales by district and year, to be stored beside gold and merged by `reports.price_quantiles`."""
    return sketches.sketched(silver_table(spark, root, "transactions", date, year), size=size)


def dimension_updates(spark: SparkSession, root: str, date: str | None = None) -> list[DataFrame]:
    """New figures for the district dimension, under its column names."""
    areas = silver_table(spark, root, "arrondissements", date)
    return [
        areas.select(
            "arrondissement", "superficie_km2", F.col("population_totale").alias("population_2020"), "densite_population"
        ),
        silver_table(spark, root, "residences_principales", date).select("arrondissement", "nb_residences_principales"),
    ]


def run_gold(
    spark: SparkSession,
    root: str,
    url: str,
    table: str = "indicateurs_gold",
    dimension: str = "arrondissements",
    date: str | None = None,
    year: int | None = None,
    accuracy: int | None = None,
    mode: str = "overwrite",
    runs: str | None = None,
    crime_options: dict | None = None,
    **properties: str,
) -> None:
    """Update the dimension and write the gold table over JDBC.

    Overwriting with one year would leave no other year in the table, so the two together are refused.
    """
    if year is not None and mode == "overwrite":
        raise ConfigurationError("one year cannot overwrite the whole table: give the write mode append")
    with recorded(spark, runs, "gold", "all", "gold") as run:
        for updates in dimension_updates(spark, root, date):
            update_jdbc(updates, url, dimension, "arrondissement", **properties)
        write_jdbc(run.writes(build_gold(spark, root, date, year, accuracy, **(crime_options or {}))), url, table, mode, **properties)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="terrazzo")
    jobs = parser.add_subparsers(dest="job", required=True)
    today = dt.date.today().isoformat()

    feeds = jobs.add_parser("bronze")
    feeds.add_argument("--source", required=True, choices=[*bronze.FEEDS, "all"])
    feeds.add_argument("--input-path", required=True)
    feeds.add_argument("--output-path", required=True)
    feeds.add_argument("--date", default=today)
    feeds.add_argument("--at-once", type=int, default=1, help="sources that run side by side")

    refines = jobs.add_parser("silver")
    refines.add_argument("--source", required=True, choices=[*silver.STEPS, "all"])
    refines.add_argument("--bronze-path", required=True)
    refines.add_argument("--silver-path", required=True)
    refines.add_argument("--date", default=today)

    builds = jobs.add_parser("gold")
    builds.add_argument("--silver-path", required=True)
    builds.add_argument("--jdbc-url", required=True)
    builds.add_argument("--jdbc-user", required=True)
    builds.add_argument("--jdbc-password", required=True)
    builds.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    builds.add_argument("--jdbc-table", default="indicateurs_gold")
    builds.add_argument("--jdbc-dimension", default="arrondissements")
    builds.add_argument("--date", default=None, help="ingestion date to read, the newest by default")
    builds.add_argument("--annee", type=int, default=None, help="one year, to be appended")
    builds.add_argument("--accuracy", type=int, default=None, help="sketch quantiles instead of computing them exactly")
    builds.add_argument("--write-mode", choices=["overwrite", "append"], default="overwrite")

    builds.add_argument("--burglary-terms", nargs="+", default=BURGLARY_TERMS, help="terms of burglary labels")
    builds.add_argument("--violence-terms", nargs="+", default=VIOLENCE_TERMS, help="terms of violence labels")
    builds.add_argument("--ignore-case", action="store_true", help="find the terms in either letter case")

    for job in (feeds, refines, builds):
        job.add_argument("--runs-path", default=None, help="folder of the run log")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"terrazzo-{args.job}")
    if args.job == "bronze":
        sources = list(bronze.FEEDS) if args.source == "all" else [args.source]
        run_bronze(spark, sources, args.input_path, args.output_path, args.date, args.runs_path, args.at_once)
    elif args.job == "silver":
        # air has no delivery on some days, so it is refined only when asked for
        sources = [s for s in silver.STEPS if s != "airparif"] if args.source == "all" else [args.source]
        run_silver(spark, sources, args.bronze_path, args.silver_path, args.date, args.runs_path)
    else:
        run_gold(
            spark, args.silver_path, args.jdbc_url, args.jdbc_table, args.jdbc_dimension, args.date, args.annee,
            args.accuracy, args.write_mode, args.runs_path,
            {"burglary": args.burglary_terms, "violence": args.violence_terms, "ignore_case": args.ignore_case},
            user=args.jdbc_user, password=args.jdbc_password, driver=args.jdbc_driver,
        )


if __name__ == "__main__":
    main()
