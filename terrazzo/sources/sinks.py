"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.operators.upserts import one_per_key
from terrazzo.operators.filters import with_ingestion_date
from terrazzo.schemas import INGESTION_DATE


def write_dated(df: DataFrame, root: str, source: str, date: str) -> None:
    """Write one ingestion date of a table. Running a date again replaces that date only."""
    (
        with_ingestion_date(df.drop(*INGESTION_DATE), date)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*INGESTION_DATE)
        .parquet(f"{root}/{source}")
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch: int = 10_000,
    connections: int | None = None,
    **properties: str,
) -> None:
    """Write a table over JDBC in batches.

    Overwriting empties the table instead of dropping it, so its declared types, keys and
    defaults stay. `connections` bounds how many tasks write at once.
    """
    writer = (
        df.write.format("jdbc")
        .mode(mode)
        .options(url=url, dbtable=table, batchsize=batch, truncate=True, **properties)
    )
    if connections is not None:
        writer = writer.option("numPartitions", connections)
    writer.save()


def update_statement(table: str, updates: str, key: str, columns: list[str]) -> str:
    """SQL that sets columns of matched rows from a table of updates; a null update keeps the old
    value, and running it again changes nothing."""
    match = f"FROM {updates} u WHERE u.{key} = {table}.{key}"
    sets = ", ".join(f"{c} = COALESCE((SELECT u.{c} {match}), {c})" for c in columns)
    return f"UPDATE {table} SET {sets} WHERE EXISTS (SELECT 1 {match})"


def update_jdbc(updates: DataFrame, url: str, table: str, key: str, **properties: str) -> None:
    """Update matched rows of a database table by key, without inserting.

    The updates, with the key and the table's own column names, are written to `<table>_updates`;
    the database then joins them itself, so tables that refer to this one stay as they are.
    """
    landed = f"{table}_updates"
    write_jdbc(one_per_key(updates, key, None), url, landed, **properties)
    statement = update_statement(table, landed, key, [c for c in updates.columns if c != key])
    reader = updates.sparkSession.read.format("jdbc")
    # the statement runs when the session of this small read is opened
    reader.options(url=url, dbtable=landed, sessionInitStatement=statement, **properties).load().count()


def as_messages(df: DataFrame, key: str, values: list[str] | None = None) -> DataFrame:
    """Rows to keyed JSON messages `(key, value)`."""
    fields: list[str | Column] = list(values or df.columns)
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def write_messages(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Append messages to a topic (needs Spark's Kafka connector on the class path)."""
    messages.write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic, **options}).save()


def write_csv(df: DataFrame, path: str, sep: str = ",", by: list[str] = []) -> None:
    """CSV files with a header, in a folder for each value of the `by` columns, which the files do not hold."""
    df.write.mode("overwrite").partitionBy(*by).options(header=True, sep=sep).csv(path)
