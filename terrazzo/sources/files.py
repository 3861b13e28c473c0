"""File readers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.errors import IngestionError
from terrazzo.operators.filters import matching
from terrazzo.schemas import INGESTION_DATE, INGESTION_FIELDS
from terrazzo.sources import store


def read_csv(spark: SparkSession, path: str | list[str], sep: str = ",", schema: T.StructType | None = None) -> DataFrame:
    """CSV files with a header, every column as text. `path` may be a glob.

    Without a schema the names come from the header of one file. Either way every file's header
    is checked against the names, so files in another column order fail instead of mixing up.
    """
    options = {"header": True, "sep": sep}
    if schema is None:
        schema = spark.read.options(**options, inferSchema=False).csv(path).schema
    return spark.read.options(**options, enforceSchema=False).schema(schema).csv(path)


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON documents that span lines, one document or one array of records per file.

    Spark reads such a file in one task; land large deliveries as many files.
    """
    return spark.read.schema(schema).json(path, multiLine=True)


def read_members(spark: SparkSession, path: str, column: str, members: list) -> DataFrame:
    """Parquet rows whose column is one of the members; the filter is pushed into the scan."""
    return spark.read.parquet(path).filter(F.col(column).isin(members))


def required(read: Callable[[], DataFrame]) -> DataFrame:
    """Run a read; a missing path is an `IngestionError`."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise IngestionError(f"missing input: {e.getMessageParameters()}") from e


def optional(read: Callable[[], DataFrame]) -> DataFrame | None:
    """Run a read; a missing path gives None."""
    try:
        return required(read)
    except IngestionError:
        return None


def trimmed_header(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def find_column(df: DataFrame, having: str, lacking: str) -> str:
    """The first column whose name contains one text and not the other."""
    for name in df.columns:
        if having in name and lacking not in name:
            return name
    raise IngestionError(f"no column with {having!r} and without {lacking!r} in {df.columns}")


def read_layer(spark: SparkSession, root: str, source: str, schema: T.StructType | None = None) -> DataFrame:
    """A bronze or silver table with its ingestion date columns.

    Those are declared as text: inferred, month "06" would come back as the number 6.
    """
    if schema is None:
        schema = spark.read.parquet(f"{root}/{source}").schema
    return spark.read.schema(_dated(schema)).parquet(f"{root}/{source}")


def _dated(schema: T.StructType) -> T.StructType:
    dates = {f.name for f in INGESTION_FIELDS}
    return T.StructType([f for f in schema if f.name not in dates] + INGESTION_FIELDS)


def ingestion_dates(spark: SparkSession, root: str, source: str) -> Iterator[str]:
    """Ingestion dates `yyyy-MM-dd` of a table, the newest first.

    Folders of partitions are listed one level at a time and only as far as the caller goes on, so the newest date costs three
    listings, however many dates and files there are. No folder of data files is listed.
    """

    def below(path: str, columns: tuple[str, ...], found: tuple[str, ...]) -> Iterator[str]:
        if not columns:
            yield "-".join(found)
            return
        mark = f"{columns[0]}="
        values = [n.removeprefix(mark) for n in store.folders(spark, path) if n.startswith(mark)]
        for value in sorted(values, reverse=True):
            yield from below(f"{path}/{mark}{value}", columns[1:], (*found, value))

    return below(f"{root}/{source}", INGESTION_DATE, ())


def newest_date(spark: SparkSession, root: str, source: str) -> str | None:
    """The newest ingestion date of a table, None without any; a year or month without a day below it does not count."""
    return next(ingestion_dates(spark, root, source), None)


def read_ingestion(spark: SparkSession, root: str, source: str, date: str, schema: T.StructType | None = None) -> DataFrame:
    """One ingestion date of a table, read from its own folder, so that no other date's files are listed.

    A date without a folder has no rows; a missing table is an error.
    """
    base = f"{root}/{source}"
    leaf = "/".join([base, *(f"{column}={part}" for column, part in zip(INGESTION_DATE, date.split("-")))])
    if not store.exists(spark, leaf):
        # fails where the table is missing
        return read_layer(spark, root, source, schema).limit(0) if not store.exists(spark, base) else _without_rows(spark, root, source, schema)
    if schema is None:
        schema = spark.read.parquet(leaf).schema
    return spark.read.schema(_dated(schema)).option("basePath", base).parquet(leaf)


def _without_rows(spark: SparkSession, root: str, source: str, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        newest = newest_date(spark, root, source)
        if newest is not None:
            return read_ingestion(spark, root, source, newest).limit(0)
    return spark.createDataFrame([], _dated(schema or T.StructType()))


def read_newest(spark: SparkSession, root: str, source: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest ingestion date of a table; of a table without dates no rows."""
    date = newest_date(spark, root, source)
    return read_layer(spark, root, source, schema).limit(0) if date is None else read_ingestion(spark, root, source, date, schema)


def read_silver(
    spark: SparkSession, root: str, source: str, year: int | None = None, date: str | None = None
) -> DataFrame:
    """A silver table, optionally one ingestion date, and one year if it has years."""
    df = read_layer(spark, root, source) if date is None else read_ingestion(spark, root, source, date)
    return matching(df, annee=year) if "annee" in df.columns else df


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Landed API pages `(total_count, results)` to one row per record."""
    return pages.select(F.inline("results"))


def page_totals(pages: DataFrame) -> DataFrame:
    """Records landed against the total the service announced."""
    return pages.agg(
        F.sum(F.size("results")).alias("n_records"), F.max("total_count").cast("long").alias("total_count")
    ).withColumn("complete", F.col("n_records") == F.col("total_count"))
