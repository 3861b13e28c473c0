"""Run log: what ran, for how long, how many rows, and how it ended."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrazzo.functions.numbers import share_of
from terrazzo.operators.quantiles import exact_quantiles
from terrazzo.schemas import RUNS


class Run:
    """One run while it lasts. Rows are counted by the job that reads or writes them, not by a
    job of their own."""

    def __init__(self, logged: bool) -> None:
        self.logged = logged
        self.status: str | None = None
        self._in: Observation | None = None
        self._out: Observation | None = None

    def reads(self, df: DataFrame, **figures: Column) -> DataFrame:
        """Count the rows of an input of a job that will run, and further aggregates by name. Counting what
        is read keeps filters out of the scan, so nothing is counted without a run log."""
        if not self.logged:
            return df
        self._in = Observation()
        return df.observe(self._in, F.count(F.lit(1)).alias("n"), *[f.alias(name) for name, f in figures.items()])

    def writes(self, df: DataFrame, **figures: Column) -> DataFrame:
        """Count the rows of an output that will be written, and further aggregates by name."""
        if not self.logged:
            return df
        self._out = Observation()
        return df.observe(self._out, F.count(F.lit(1)).alias("n"), *[f.alias(name) for name, f in figures.items()])

    def skip(self) -> None:
        self.status = "skipped"

    def counts(self) -> tuple[int | None, int | None]:
        return tuple(o.get["n"] if o is not None else None for o in (self._in, self._out))

    def figures(self) -> dict[str, str]:
        """The further aggregates as text; those without a value are left out."""
        found = {k: v for o in (self._in, self._out) if o is not None for k, v in o.get.items() if k != "n"}
        return {k: str(v) for k, v in found.items() if v is not None}


@contextmanager
def recorded(
    spark: SparkSession, table: str | None, name: str, source: str, layer: str, **metadata: str
) -> Iterator[Run]:
    """Append a row to the run log when the block ends; an error is logged and raised again."""
    run, started = Run(table is not None), dt.datetime.now(dt.UTC).replace(tzinfo=None)
    error, counts = None, (None, None)
    try:
        yield run
        run.status = run.status or "success"
        if run.status == "success":
            counts = run.counts()
            metadata = metadata | run.figures()
    except Exception as e:
        run.status, error = "failed", str(e)
        raise
    finally:
        if table is not None:
            finished = dt.datetime.now(dt.UTC).replace(tzinfo=None)
            seconds = round((finished - started).total_seconds(), 3)
            run_id = uuid.uuid4().hex
            row = (
                run_id, name, source, layer, started.date(), started, finished, seconds, *counts, None,
                run.status, error, metadata,
            )
            # a folder of its own: runs that end at the same time do not share the writer's temporary folder
            spark.createDataFrame([row], RUNS).coalesce(1).write.parquet(f"{table}/{run_id}")


def run_log(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(RUNS).option("recursiveFileLookup", True).parquet(table)


def run_report(log: DataFrame) -> DataFrame:
    """Per job: runs, success rate in percent and median duration."""
    totals = log.groupBy("pipeline_name").agg(
        F.count("*").alias("n_runs"), share_of(F.col("statut") == "success").alias("success_rate")
    )
    medians = exact_quantiles(log, ("pipeline_name",), {"duration_p50": ("duration_s", 0.5)})
    return totals.join(medians, "pipeline_name", "left")
