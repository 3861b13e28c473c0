"""A table of changed rows: one snapshot, the changes since, and an atomic switch from one snapshot to the next.

    <path>/changes/writer=<stream>/batch=<n>/   rows of one batch, complete once `_committed` stands there
    <path>/snapshots/<name>/                    the newest live row of each key
    <path>/_current/<number>                    which snapshot counts and up to which batch of each stream it holds

The file of the greatest number is the state of the table. It is renamed into place after its snapshot is complete, so a reader sees the old state or
the new one. What the last state but one needs is removed only then, so that readers which are under way can finish. All moments are
instants: no rule depends on the time zone of a session.
"""  # noqa: E501

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.operators.upserts import latest_per_key
from terrazzo.sources import store

EXPIRY = dt.timedelta(hours=24)
#: batches after which a writer makes a new snapshot
COMPACT_EVERY = 64
INSERTED = "inserted_at"
#: rows that no stream wrote
DIRECT = "direct"
_PLACE = [T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())]


@dataclass(frozen=True)
class State:
    """A snapshot (none at first) and the last batch of each writer that it holds."""

    number: int = 0
    snapshot: str | None = None
    upto: dict[str, int] = field(default_factory=dict)


def moment(as_of: dt.datetime | None) -> Column:
    """The instant that counts: now, or the given one; without a zone it is taken as UTC."""
    if as_of is None:
        return F.current_timestamp()
    aware = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit((aware - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)))


def unexpired(df: DataFrame, as_of: Column, inserted: str = INSERTED, after: dt.timedelta = EXPIRY) -> DataFrame:
    """Rows that arrived within the expiry before a moment."""
    return df.filter(F.col(inserted) > as_of - F.lit(after))


def state(spark: SparkSession, path: str) -> State:
    """The state that counts now."""
    numbers = [n for n in store.names(spark, f"{path}/_current") if n.isdigit()]
    if not numbers:
        return State()
    said = json.loads(store.get_text(spark, f"{path}/_current/{numbers[-1]}"))
    return State(int(numbers[-1]), said["snapshot"], said["upto"])


def batches(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Writer and number of every complete batch that is there."""
    root = f"{path}/changes"
    found = [(w.removeprefix("writer="), int(b.removeprefix("batch="))) for w in store.folders(spark, root) for b in store.folders(spark, f"{root}/{w}")]
    return sorted((w, b) for w, b in found if store.exists(spark, f"{_folder(path, w, b)}/_committed"))


def pending(spark: SparkSession, path: str, of: State) -> list[tuple[str, int]]:
    """The complete batches that the snapshot of a state does not hold."""
    return [(w, b) for w, b in batches(spark, path) if b > of.upto.get(w, -1)]


def _folder(path: str, writer: str, batch: int) -> str:
    return f"{path}/changes/writer={writer}/batch={batch}"


def _stored(schema: T.StructType) -> T.StructType:
    stamp = [] if INSERTED in schema.fieldNames() else [T.StructField(INSERTED, T.TimestampType())]
    return T.StructType([*schema.fields, *stamp])


def _rows(spark: SparkSession, path: str, schema: T.StructType, of: State, new: list[tuple[str, int]]) -> DataFrame:
    """The rows of a snapshot and of the given batches, with writer and batch."""
    full = T.StructType([*_stored(schema).fields, *_PLACE])
    rows = spark.read.schema(full).parquet(f"{path}/snapshots/{of.snapshot}") if of.snapshot else spark.createDataFrame([], full)
    if new:
        rows = rows.unionByName(spark.read.schema(full).option("basePath", f"{path}/changes").parquet(*[_folder(path, *n) for n in new]))
    return rows


def _newest(rows: DataFrame, key: str, order: list[str], as_of: dt.datetime | None, after: dt.timedelta) -> DataFrame:
    """Of equal order the row of the later batch counts."""
    return latest_per_key(unexpired(rows, moment(as_of), after=after), key, [*order, "batch", "writer"])


def compact(
    spark: SparkSession,
    path: str,
    key: str,
    schema: T.StructType,
    order: list[str],
    as_of: dt.datetime | None = None,
    after: dt.timedelta = EXPIRY,
) -> bool:
    """Make a snapshot of the newest live row of each key and switch to it; False if there is nothing new, or another writer was first.

    A failure before the switch leaves the old state; one after it leaves old files, which the next compaction removes.
    """
    old = state(spark, path)
    new = pending(spark, path, old)
    if not new:
        return False
    name = f"{old.number + 1:020d}-{uuid.uuid4().hex}"
    _newest(_rows(spark, path, schema, old, new), key, order, as_of, after).write.parquet(f"{path}/snapshots/{name}")
    upto = old.upto | {w: b for w, b in new}
    if not store.put_text(spark, f"{path}/_current/{old.number + 1:020d}", json.dumps({"snapshot": name, "upto": upto})):
        store.remove(spark, f"{path}/snapshots/{name}")
        return False
    # the state before this one stays readable
    for w, b in batches(spark, path):
        if b <= old.upto.get(w, -1):
            store.remove(spark, _folder(path, w, b))
    for other in store.folders(spark, f"{path}/snapshots"):
        if int(other.split("-")[0]) < old.number or (int(other.split("-")[0]) <= old.number and other != old.snapshot):
            store.remove(spark, f"{path}/snapshots/{other}")
    for number in store.names(spark, f"{path}/_current"):
        if number.isdigit() and int(number) < old.number:
            store.remove(spark, f"{path}/_current/{number}")
    return True


def writer_of(spark: SparkSession) -> str:
    """The stream whose batch is being written, the same after a restart from its checkpoint; or none."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT


def write_changes(
    path: str, key: str, order: list[str], after: dt.timedelta = EXPIRY, compact_every: int = COMPACT_EVERY
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` writer of changed rows. Rows without `inserted_at` are stamped.

    A batch that is run again replaces its own folder, or is passed over if a snapshot holds it already, so repeats change nothing.
    Every `compact_every` batches become a new snapshot without expired rows: neither the number of files that a reader opens nor the size of the table
    grows with the age of the stream. Several streams may write one table.
    """  # noqa: E501

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch if INSERTED in batch.columns else batch.withColumn(INSERTED, F.current_timestamp())
        writer = writer_of(spark)
        now = state(spark, path)
        if number <= now.upto.get(writer, -1):
            return
        folder = _folder(path, writer, number)
        rows.write.mode("overwrite").parquet(folder)
        store.put_text(spark, f"{folder}/_committed", "", replace=True)
        if len(pending(spark, path, now)) >= compact_every:
            compact(spark, path, key, T.StructType([f for f in rows.schema if f.name != INSERTED]), order, after=after)

    return write


def read_changes(
    spark: SparkSession,
    path: str,
    key: str,
    schema: T.StructType,
    order: list[str],
    as_of: dt.datetime | None = None,
    after: dt.timedelta = EXPIRY,
) -> DataFrame:
    """The newest live row of each key, by `order`, with its `inserted_at`: one snapshot and the batches since.

    Rows expire `after` their arrival; `as_of` is the moment that counts, now by default. Of a table without rows the result has none.
    """
    now = state(spark, path)
    rows = _rows(spark, path, schema, now, pending(spark, path, now))
    return _newest(rows, key, order, as_of, after).select(*_stored(schema).fieldNames())
