"""Streaming. Messages are derived from the events, landed as files and consumed by real
streaming queries that stop when everything landed has been read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.catalog import tables as t
from terrazzo.catalog.layers import AIR_COUNTS, AIR_LABEL_SQL
from terrazzo.catalog.registry import query
from terrazzo.catalog.sqltext import code
from terrazzo.functions.codes import code_of_district
from terrazzo.operators.upserts import latest_per_key
from terrazzo.plans.reports import air_labels
from terrazzo.schemas import RAW_AIR, struct
from terrazzo.session import staging_path
from terrazzo.streaming import live

MESSAGE = struct(("insee", T.StringType()), ("event_id", T.LongType()), ("label", T.StringType()))
NOW = {"availableNow": True}


def events_stream(spark, sf) -> DataFrame:
    schema = t.table(spark, sf, "events").schema
    # a pattern, so that one file and a folder of files both work
    return live.read_landed(spark, f"{sf}/events.parquet*", schema)


def messages(spark, sf) -> DataFrame:
    """One message per event: errors are cut-off JSON, sign-ups name no key."""
    kind = F.col("event_type")
    key = F.when(kind != "signup", code_of_district(F.col("user_id") % 20 + 1))
    text = F.to_json(F.struct(key.alias("insee"), "event_id", F.col("event_type").alias("label")))
    value = F.when(kind == "error", F.substring(text, 1, 20)).otherwise(text)
    return t.table(spark, sf, "events").select("event_id", value.alias("value"))


def _land(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _consumed(spark, landed: str, base: str) -> None:
    stream = live.read_landed(spark, landed, struct(("event_id", T.LongType()), ("value", T.StringType())))
    live.consume(
        stream.select("value"), MESSAGE, "insee", ["event_id"], f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", NOW
    ).awaitTermination()


_GOOD = "event_type NOT IN ('error', 'signup')"
_LATEST = (
    f"SELECT {code('user_id % 20 + 1')} AS insee, max(event_id) AS event_id, arg_max(event_type, event_id) AS label "
    f"FROM events WHERE {_GOOD} GROUP BY 1"
)


@query("source_landed_stream", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def source_landed_stream(spark, sf):
    """A stream of files counted through a streaming query."""
    base = staging_path(spark, "stream")
    written = (
        events_stream(spark, sf)
        .select("event_id", "event_type")
        .writeStream.format("parquet")
        .options(path=f"{base}/out", checkpointLocation=f"{base}/checkpoint")
        .trigger(**NOW)
        .start()
    )
    written.awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_latest", _LATEST)
def stream_latest(spark, sf):
    base = staging_path(spark, "stream")
    _land(messages(spark, sf), f"{base}/landed")
    _consumed(spark, f"{base}/landed", base)
    return live.read_changes(spark, f"{base}/table", "insee", MESSAGE, ["event_id"]).drop("inserted_at")


@query("stream_rejects", "SELECT count(*) AS n, count(*) FILTER (event_type = 'signup') AS n_without_key FROM events WHERE event_type IN ('error', 'signup')")
def stream_rejects(spark, sf):
    """Bad messages end in the side table as they came."""
    base = staging_path(spark, "stream")
    _land(messages(spark, sf), f"{base}/landed")
    _consumed(spark, f"{base}/landed", base)
    rejects = spark.read.schema("value string").parquet(f"{base}/rejects")
    return rejects.agg(F.count("*").alias("n"), F.count_if(F.col("value").endswith("}")).alias("n_without_key"))


@query("stream_resumed", _LATEST)
def stream_resumed(spark, sf):
    """The consumer stops after the newer half and goes on from its checkpoint with the older
    half, which must not replace newer readings."""
    base = staging_path(spark, "stream")
    rows = messages(spark, sf)
    middle = t.table(spark, sf, "events").agg((F.max("event_id") / 2).alias("middle")).scalar()
    _land(rows.filter(F.col("event_id") > middle), f"{base}/landed")
    _consumed(spark, f"{base}/landed", base)
    _land(rows.filter(F.col("event_id") <= middle), f"{base}/landed")
    _consumed(spark, f"{base}/landed", base)
    return live.read_changes(spark, f"{base}/table", "insee", MESSAGE, ["event_id"]).drop("inserted_at")


@query("stream_compacted", _LATEST)
def stream_compacted(spark, sf):
    """Twelve small batches and a snapshot after every fourth: readers see one snapshot and what came since."""
    base = staging_path(spark, "stream")
    for part in range(12):
        _land(messages(spark, sf).filter(F.pmod(F.xxhash64("event_id"), F.lit(12)) == part).coalesce(1), f"{base}/landed")
    schema = struct(("event_id", T.LongType()), ("value", T.StringType()))
    stream = live.read_landed(spark, f"{base}/landed", schema, maxFilesPerTrigger="1")
    paths = (f"{base}/table", f"{base}/rejects", f"{base}/checkpoint")
    live.consume(stream.select("value"), MESSAGE, "insee", ["event_id"], *paths, NOW, compact_every=4).awaitTermination()
    return live.read_changes(spark, f"{base}/table", "insee", MESSAGE, ["event_id"]).drop("inserted_at")


_ON_TIME = "event_id > (SELECT max(event_id) / 2 FROM events) OR ts >= (SELECT max(ts) FROM events WHERE event_id > (SELECT max(event_id) / 2 FROM events)) - INTERVAL 1 DAY"


@query(
    "stream_late",
    f"WITH good AS (SELECT *, {_ON_TIME} AS on_time FROM events WHERE user_id IS NOT NULL) "
    f"SELECT {code('user_id % 20 + 1')} AS insee, event_id, epoch_us(ts) AS moment, true AS late FROM good WHERE NOT on_time "
    f"UNION ALL SELECT {code('user_id % 20 + 1')}, max(event_id), arg_max(epoch_us(ts), event_id), false FROM good WHERE on_time GROUP BY 1",
)
def stream_late(spark, sf):
    """The newer half of the events arrives first: of the other half, what lies over a day behind goes to the side table."""
    base = staging_path(spark, "stream")
    schema = struct(("insee", T.StringType()), ("event_id", T.LongType()), ("moment", T.LongType()))
    rows = t.table(spark, sf, "events").filter(F.col("user_id").isNotNull())
    said = F.struct(code_of_district(F.col("user_id") % 20 + 1).alias("insee"), "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("moment"))
    middle = t.table(spark, sf, "events").agg((F.max("event_id") / 2).alias("middle")).scalar()
    for half in (F.col("event_id") > middle, F.col("event_id") <= middle):
        _land(rows.filter(half).select(F.to_json(said).alias("value")), f"{base}/landed")
        stream = live.read_landed(spark, f"{base}/landed", struct(("value", T.StringType())))
        live.consume(
            stream, schema, "insee", ["event_id"], f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", NOW,
            event_time=F.timestamp_micros("moment"), delay=dt.timedelta(days=1), late=f"{base}/late",
        ).awaitTermination()
    late = spark.read.schema(schema).parquet(f"{base}/late").select(*schema.fieldNames(), F.lit(True).alias("late"))
    kept = live.read_changes(spark, f"{base}/table", "insee", schema, ["event_id"]).drop("inserted_at").withColumn("late", F.lit(False))
    return late.unionByName(kept)


@query("stream_lookup", f"SELECT * FROM ({_LATEST}) WHERE insee = '75107'")
def stream_lookup(spark, sf):
    base = staging_path(spark, "stream")
    _land(messages(spark, sf), f"{base}/landed")
    _consumed(spark, f"{base}/landed", base)
    table = live.read_changes(spark, f"{base}/table", "insee", MESSAGE, ["event_id"])
    return live.lookup(table, "insee", "75107").drop("inserted_at")


@query(
    "stream_lookup_expired",
    f"SELECT {code('user_id % 20 + 1')} AS insee, max(event_id) AS event_id, arg_max(event_type, event_id) AS label "
    "FROM events WHERE user_id % 20 <> 6 GROUP BY 1",
)
def stream_lookup_expired(spark, sf):
    """The readings of one code arrived thirty hours ago: a moment without them is all that is left of it."""
    base = staging_path(spark, "stream")
    key = F.col("user_id") % 20 + 1
    rows = t.table(spark, sf, "events").select(code_of_district(key).alias("insee"), "event_id", F.col("event_type").alias("label"))
    arrived = F.when(F.col("insee") == "75107", F.current_timestamp() - F.expr("INTERVAL 30 HOUR")).otherwise(F.current_timestamp())
    live.write_changes(f"{base}/table", "insee", ["event_id"])(rows.withColumn("inserted_at", arrived), 0)
    table = live.read_changes(spark, f"{base}/table", "insee", MESSAGE, ["event_id"])
    return live.lookup(table, "insee").drop("inserted_at")


@query(
    "stream_air",
    f"WITH {AIR_COUNTS} SELECT {code('arrondissement')} AS insee, CAST(max(day) AS VARCHAR) AS timestamp, "
    f"{AIR_LABEL_SQL}[arg_max(n_no2, day) + 1] AS air_label FROM air_counts GROUP BY arrondissement",
)
def stream_air(spark, sf):
    """Deliveries as they land, to keyed messages, to the live table, to labels."""
    base = staging_path(spark, "stream")
    t.air_envelopes(spark, sf).write.option("maxRecordsPerFile", 1).json(f"{base}/deliveries")
    deliveries = live.read_landed(spark, f"{base}/deliveries", RAW_AIR, "json", multiLine="true")
    (
        live.air_messages(deliveries)
        .writeStream.format("parquet")
        .options(path=f"{base}/topic", checkpointLocation=f"{base}/published")
        .trigger(**NOW)
        .start()
        .awaitTermination()
    )
    topic = live.read_landed(spark, f"{base}/topic", struct(("key", T.StringType()), ("value", T.StringType())))
    live.consume(
        topic, live.AIR_MESSAGE, "insee", ["timestamp"], f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", NOW
    ).awaitTermination()
    table = live.read_changes(spark, f"{base}/table", "insee", live.AIR_MESSAGE, ["timestamp"])
    return table.select("insee", "timestamp").join(air_labels(live.air_documents(table)), "insee")


@query(
    "stream_latest_with_expiry",
    "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1",
)
def stream_latest_with_expiry(spark, sf):
    """The stateful processor whose state expires a day after arrival."""
    base = staging_path(spark, "stream")
    schema = struct(
        ("user_id", T.LongType()), ("event_id", T.LongType()), ("event_type", T.StringType()), ("value", T.DoubleType())
    )
    kept = (
        live.latest_with_expiry(events_stream(spark, sf), schema)
        .writeStream.outputMode("update")
        .foreachBatch(live.write_changes(f"{base}/table", "user_id", ["inserted_at"]))
        .option("checkpointLocation", f"{base}/checkpoint")
        # processing-time timers ask for further batches, so available-now would not end
        .trigger(once=True)
        .start()
    )
    kept.awaitTermination()
    return live.read_changes(spark, f"{base}/table", "user_id", schema, ["inserted_at"]).drop("inserted_at")


@query("parsed_messages", f"SELECT event_id, {code('user_id % 20 + 1')} AS insee, event_type AS label FROM events WHERE {_GOOD}")
def parsed_messages(spark, sf):
    """The batch twin of the parser."""
    both = live.parsed(messages(spark, sf), MESSAGE)
    return live.valid(both, "insee").select("event_id", "message.insee", "message.label")


@query("rejected_messages", "SELECT event_id FROM events WHERE event_type IN ('error', 'signup')")
def rejected_messages(spark, sf):
    both = live.parsed(messages(spark, sf), MESSAGE)
    return live.invalid(both, "insee").select("event_id")


@query(
    "parsed_properties",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def parsed_properties(spark, sf):
    both = live.parsed(t.table(spark, sf, "events").select("event_id", "props"), struct(("k", T.IntegerType())), "props")
    return live.valid(both, "k").select("event_id", "message.k")


@query(
    "latest_per_key",
    "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1",
)
def latest_rows(spark, sf):
    rows = t.table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return latest_per_key(rows, "user_id", ["ts", "event_id"]).drop("ts")


@query(
    "live_unexpired",
    "WITH last AS (SELECT user_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type FROM events GROUP BY 1) "
    "SELECT user_id, event_type FROM last WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR",
)
def live_unexpired(spark, sf):
    """The latest readings that had not expired when the last event arrived."""
    rows = t.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    as_of = t.table(spark, sf, "events").agg(F.max("ts")).scalar()
    latest = latest_per_key(rows, "user_id", ["ts", "event_id"])
    return live.unexpired(latest, as_of, inserted="ts").select("user_id", "event_type")
