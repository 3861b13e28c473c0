"""Live readings: parse messages, keep the latest per key, forget them after a day.

The table of readings is in `changes`, event time and late messages are in `lateness`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from terrazzo.errors import ConfigurationError
from terrazzo.functions.parsing import iso_utc
from terrazzo.operators.upserts import latest_per_key
from terrazzo.schemas import struct
from terrazzo.sources.sinks import as_messages
from terrazzo.streaming import lateness
from terrazzo.streaming.changes import COMPACT_EVERY, EXPIRY, moment, read_changes, unexpired, write_changes  # noqa: F401

POLL_INTERVAL = "1 hour"
# `data` is kept as a variant, whatever its shape: it is parsed once, with its message
AIR_MESSAGE = struct(("insee", T.StringType()), ("timestamp", T.StringType()), ("data", T.VariantType()))


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic from its earliest message (needs Spark's Kafka connector). Progress is kept in
    the checkpoint of the query that consumes it."""
    return (
        spark.readStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **options})
        .load()
    )


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """Landed files as a stream."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def parsed(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add `message`, the parsed JSON value, null where it is not valid JSON of the schema's kind."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    struct = F.from_json(
        F.col(value).cast("string"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    good = F.struct(*[F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields])
    is_good = F.col("_m").isNotNull() & F.col("_m._corrupt").isNull()
    return messages.withColumn("_m", struct).withColumn("message", F.when(is_good, good)).drop("_m")


def has_key(key: str) -> Column:
    """The message was parsed and names its key."""
    return F.col("message").isNotNull() & F.col(f"message.{key}").isNotNull()


def valid(messages: DataFrame, key: str) -> DataFrame:
    return messages.filter(has_key(key))


def invalid(messages: DataFrame, key: str) -> DataFrame:
    """Bad messages for the side table; they never stop the stream."""
    return messages.filter(~has_key(key)).drop("message")


def stamped(df: DataFrame, column: str = "inserted_at") -> DataFrame:
    """Add the arrival time of the batch."""
    return df.withColumn(column, F.current_timestamp())


def stamped_text(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Add the current time as ISO 8601 text, as messages carry it."""
    return df.withColumn(column, iso_utc(F.current_timestamp()))


def latest(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Running latest row per key; write it in update mode.

    A built-in aggregation: rows of one key are combined within each task before the shuffle,
    and the state holds one row per key.
    """
    return latest_per_key(stream, key, order)


def air_messages(deliveries: DataFrame) -> DataFrame:
    """Air deliveries to one keyed message per code, `{insee, timestamp, data}`.

    Codes that could not be fetched are listed apart in a delivery and yield no message.
    """
    rows = deliveries.select(F.inline("arrondissements"))
    return as_messages(rows.select("insee", F.col("fetched_at").alias("timestamp"), "data"), "insee")


def air_documents(table: DataFrame) -> DataFrame:
    """Live rows of air messages to `(insee, document)`, the document as a variant made of the stored one; `to_json` gives its text."""
    return table.select("insee", F.to_variant_object(F.struct("data")).alias("document"))


def consume(
    messages: DataFrame,
    schema: T.StructType,
    key: str,
    order: list[str],
    table: str,
    rejects: str,
    checkpoint: str,
    trigger: dict | None = None,
    after: dt.timedelta = EXPIRY,
    compact_every: int = COMPACT_EVERY,
    event_time: Column | None = None,
    delay: dt.timedelta = dt.timedelta(0),
    late: str | None = None,
) -> StreamingQuery:
    """Start the consumer: valid messages to the change table, bad ones to a side table.

    `order` names message fields or columns that tell which message is newer. One query reads and parses each message once; a
    micro-batch is held while its parts are written. It is reduced to the newest row of each key, and no state is kept
    beyond the change table, whose rows expire: `read_changes` picks the newest live row of a key whatever batch it came in.

    With `event_time`, an expression over the message's fields, valid messages that lie more than `delay` behind the greatest event time of the batches
    before theirs go to the side table `late` instead of the change table.
    """  # noqa: E501
    if event_time is not None and late is None:
        raise ConfigurationError("late messages need a side table")
    changes = write_changes(table, key, order, after, compact_every)

    def write(batch: DataFrame, number: int) -> None:
        both = parsed(batch, schema).persist()
        try:
            rows = valid(both, key).select("message.*", *[c for c in order if c in batch.columns])
            on_time = rows
            if event_time is not None:
                mark = lateness.greatest(batch.sparkSession, late, number)
                behind = lateness.is_late(event_time, mark, delay)
                lateness.write_late(rows.filter(behind), late, number)
                on_time = rows.filter(~behind)
            changes(stamped(latest_per_key(on_time, key, order)), number)
            (
                invalid(both, key)
                .withColumn("batch", F.lit(number).cast("long"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch")
                .parquet(rejects)
            )
            if event_time is not None:
                lateness.advance(rows, event_time, late, number, mark)
        finally:
            both.unpersist()

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": POLL_INTERVAL}))
        .start()
    )


def publish(messages: DataFrame, servers: str, topic: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Stream keyed messages to a topic (needs Spark's Kafka connector)."""
    return (
        messages.writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint})
        .trigger(**(trigger or {"processingTime": POLL_INTERVAL}))
        .start()
    )


def lookup(table: DataFrame, key: str, value: str | None = None, as_of: dt.datetime | None = None) -> DataFrame:
    """Live rows by key, of one key or all; rows that know when they arrived are left out once they have expired."""
    if "inserted_at" in table.columns:
        table = unexpired(table, moment(as_of))
    return (table if value is None else table.filter(F.col(key) == value)).orderBy(key)


class LatestWithExpiry(StatefulProcessor):
    """Keeps the newest `(order, row)` of a key; Spark drops it a day after its last change.

    Emits the kept row whenever it changes. The first output column is the key, the second the
    order; a row that is not newer than the kept one is ignored.
    """

    def __init__(self, schema: T.StructType, expiry: dt.timedelta = EXPIRY):
        self.columns = schema.fieldNames()
        self.state_schema = T.StructType(schema.fields[1:])
        self.ttl_ms = int(expiry.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("latest", self.state_schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        order = self.columns[1]
        best = self.kept.get() if self.kept.exists() else None
        changed = False
        for batch in rows:
            row = batch.loc[batch[order].idxmax(), self.columns[1:]]
            if best is None or row[order] > best[0]:
                best, changed = tuple(v.item() if hasattr(v, "item") else v for v in row), True
        if changed:
            self.kept.update(best)
            yield pd.DataFrame([(*key, *best)], columns=self.columns)

    def close(self) -> None:
        pass


def newest_per_batch(key: str, order: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For `mapInPandas`: the newest row of each key within each Arrow batch."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[batch.groupby(key, sort=False)[order].idxmax()]

    return reduce


def latest_with_expiry(stream: DataFrame, schema: T.StructType, expiry: dt.timedelta = EXPIRY) -> DataFrame:
    """`latest` with expiry kept by the state store (RocksDB provider); write in update mode.

    `schema` is (key, order, other columns), neither of the first two null; `order` must be unique
    per key. Rows are reduced to one per key and Arrow batch before the shuffle, so a key that
    holds most of a micro-batch sends few of them; the state holds one row per key.
    """
    key, order = schema.fieldNames()[:2]
    return (
        stream.select(*schema.fieldNames())
        .mapInPandas(newest_per_batch(key, order), schema)
        .groupBy(key)
        .transformWithStateInPandas(LatestWithExpiry(schema, expiry), schema, "Update", "ProcessingTime")
    )
