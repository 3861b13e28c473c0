"""Streams over landed files against their batch twins."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.errors import ConfigurationError
from terrazzo.plans.reports import air_labels
from terrazzo.schemas import struct
from terrazzo.session import staging_path
from terrazzo.sources import store
from terrazzo.sources.sinks import as_messages
from terrazzo.streaming import changes, live

MESSAGE = struct(("insee", T.StringType()), ("n", T.LongType()), ("label", T.StringType()))
STORED = T.StructType([*MESSAGE.fields, T.StructField("inserted_at", T.TimestampType())])
NOW = {"availableNow": True}


def message(insee, n, label):
    return json.dumps({"insee": insee, "n": n, "label": label})


def land(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").parquet(path)


def consume(spark, base):
    stream = live.read_landed(spark, f"{base}/landed", struct(("value", T.StringType())))
    live.consume(stream, MESSAGE, "insee", ["n"], f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", NOW).awaitTermination()


def table(spark, base, schema=MESSAGE, order=("n",)):
    got = live.read_changes(spark, f"{base}/table", "insee", schema, list(order))
    return sorted((r.insee, r.n, r.label) for r in got.collect())


def test_bad_messages_go_aside_and_late_ones_do_not_win(spark):
    base = staging_path(spark, "test")
    land(spark, f"{base}/landed", [message("75101", 5, "new"), message("75102", 1, "b"), "{broken", '"text"', "", message(None, 9, "x"), "[1]"])
    consume(spark, base)
    assert table(spark, base) == [("75101", 5, "new"), ("75102", 1, "b")]
    land(spark, f"{base}/landed", [message("75101", 4, "late"), message("75101", 4, "late"), message("75103", 1, "c")])
    consume(spark, base)
    assert table(spark, base) == [("75101", 5, "new"), ("75102", 1, "b"), ("75103", 1, "c")]
    rejects = spark.read.schema("value string").parquet(f"{base}/rejects")
    assert rejects.count() == 5


def test_air_documents_are_stored_as_variants(spark):
    base = staging_path(spark, "test")
    shapes = [("75101", [{"label": "Bon"}]), ("75102", {"75101": [{"indice": "Bon"}], "75102": [{"indice": "Moyen"}]}), ("75103", []), ("75104", None),
              ("75105", "text")]
    land(spark, f"{base}/landed", [json.dumps({"insee": k, "timestamp": "1", "data": d}) for k, d in shapes] + ["{broken", '{"insee": null}'])

    def run():
        stream = live.read_landed(spark, f"{base}/landed", struct(("value", T.StringType())))
        live.consume(
            stream, live.AIR_MESSAGE, "insee", ["timestamp"], f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", NOW, compact_every=2
        ).awaitTermination()
        return live.read_changes(spark, f"{base}/table", "insee", live.AIR_MESSAGE, ["timestamp"])

    def labels(table):
        found = air_labels(live.air_documents(table))
        assert "parse_json" not in found._jdf.queryExecution().executedPlan().toString()
        return {r.insee: r.air_label for r in found.collect()}

    table = run()
    assert isinstance(table.schema["data"].dataType, T.VariantType)
    assert labels(table) == {"75101": "Bon", "75102": "Moyen", "75103": None, "75104": None, "75105": None}
    assert spark.read.parquet(f"{base}/rejects").count() == 2
    land(spark, f"{base}/landed", [json.dumps({"insee": "75101", "timestamp": "2", "data": [{"qualif": "Mauvais"}]})])
    table = run()
    assert changes.state(spark, f"{base}/table").snapshot is not None
    assert labels(table) == {"75101": "Mauvais", "75102": "Moyen", "75103": None, "75104": None, "75105": None}
    text = live.air_documents(table).select("insee", F.to_json("document").alias("text"))
    assert {r.insee: json.loads(r.text) for r in text.collect()}["75101"] == {"data": [{"qualif": "Mauvais"}]}


def test_a_repeated_batch_changes_nothing(spark):
    base = staging_path(spark, "test")
    write = live.write_changes(f"{base}/table", "insee", ["n"])
    rows = spark.createDataFrame([("75101", 1, "a", dt.datetime.now(dt.timezone.utc))], STORED)
    write(rows, 0)
    write(rows, 0)
    assert table(spark, base) == [("75101", 1, "a")]


def test_expiry_at_read_time(spark):
    now = dt.datetime(2024, 1, 2, 12)
    ages = {"a": dt.timedelta(0), "b": dt.timedelta(hours=23, minutes=59), "c": dt.timedelta(hours=24), "d": dt.timedelta(days=3)}
    df = spark.createDataFrame([(k, now - age) for k, age in ages.items()], "insee string, inserted_at timestamp")
    kept = live.unexpired(df, F.lit(now))
    assert [r.insee for r in live.lookup(kept, "insee", as_of=now).collect()] == ["a", "b"]
    assert live.lookup(df, "insee", "d", as_of=now).count() == 0 and live.lookup(df, "insee", as_of=now).count() == 2


def test_state_expires(spark):
    """After expiry an older message is the latest again."""
    base = staging_path(spark, "test")
    schema = struct(("insee", T.StringType()), ("n", T.LongType()), ("label", T.StringType()))

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/landed")
        stream = live.read_landed(spark, f"{base}/landed", schema)
        (
            live.latest_with_expiry(stream, schema, dt.timedelta(seconds=4))
            .writeStream.outputMode("update")
            .foreachBatch(live.write_changes(f"{base}/table", "insee", ["inserted_at"]))
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(once=True)
            .start()
            .awaitTermination()
        )
        return sorted(tuple(r)[:3] for r in live.read_changes(spark, f"{base}/table", "insee", schema, ["inserted_at"]).collect())

    assert run([("a", 2, "new"), ("a", 1, "old"), ("b", 1, "x")]) == [("a", 2, "new"), ("b", 1, "x")]
    time.sleep(5)
    assert run([("a", 1, "back")]) == [("a", 1, "back"), ("b", 1, "x")]


def test_keyed_messages(spark):
    df = spark.createDataFrame([("75101", 1, "é"), ("75102", 2, None)], "insee string, n int, label string")
    got = as_messages(df, "insee").collect()
    assert [(r.key, json.loads(r.value)) for r in got] == [
        ("75101", {"insee": "75101", "n": 1, "label": "é"}), ("75102", {"insee": "75102", "n": 2})
    ]


def test_stamps(spark):
    df = live.stamped_text(live.stamped(spark.range(1)))
    row = df.first()
    assert dt.datetime.fromisoformat(row["timestamp"]).replace(tzinfo=None) == row["inserted_at"]


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    df = spark.range(10000).selectExpr("'a' as insee", "id as n", "cast(id as string) as label").coalesce(1)
    got = df.mapInPandas(live.newest_per_batch("insee", "n"), df.schema)
    assert got.count() == 1 and tuple(got.first()) == ("a", 9999, "9999")


def test_arrival_order(spark):
    """Ordered by a column beside the message, the last to arrive wins whatever it says."""
    base = staging_path(spark, "test")
    arrived = [(0, message("75101", 9, "first")), (1, message("75101", 1, "last")), (2, message("75102", 1, "only"))]
    spark.createDataFrame(arrived, "offset long, value string").write.parquet(f"{base}/landed")
    stream = live.read_landed(spark, f"{base}/landed", struct(("offset", T.LongType()), ("value", T.StringType())))
    live.consume(stream, MESSAGE, "insee", ["offset"], f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", NOW).awaitTermination()
    stored = T.StructType([*MESSAGE.fields, T.StructField("offset", T.LongType())])
    assert table(spark, base, stored, ["offset"]) == [("75101", 1, "last"), ("75102", 1, "only")]


def files_below(path):
    return [f for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_the_live_table_does_not_grow_with_its_age(spark):
    base = staging_path(spark, "test")
    path = f"{base}/table"
    write = live.write_changes(path, "insee", ["n"], compact_every=5)
    opened, kept = [], []
    for batch in range(24):
        write(spark.createDataFrame([(f"751{batch % 20 + 1:02d}", batch, "a")], MESSAGE).coalesce(1), batch)
        opened.append(len(live.read_changes(spark, path, "insee", MESSAGE, ["n"]).inputFiles()))
        kept.append(len(files_below(path)))
    assert max(opened) <= 6 and max(kept) <= 2 * 6
    assert table(spark, base) == sorted((f"751{n % 20 + 1:02d}", n, "a") for n in range(4, 24))


def test_expired_rows_leave_with_the_next_snapshot(spark):
    base = staging_path(spark, "test")
    now = dt.datetime.now(dt.timezone.utc)
    write = live.write_changes(f"{base}/table", "insee", ["n"], compact_every=3)
    for batch, days in enumerate((40, 3, 0)):
        write(spark.createDataFrame([(f"7510{batch}", batch, "a", now - dt.timedelta(days=days))], STORED), batch)
    of = changes.state(spark, f"{base}/table")
    assert spark.read.parquet(f"{base}/table/snapshots/{of.snapshot}").count() == 1
    assert table(spark, base) == [("75102", 2, "a")]
    later = live.read_changes(spark, f"{base}/table", "insee", MESSAGE, ["n"], as_of=now + dt.timedelta(days=2))
    assert later.count() == 0


def test_a_reader_of_the_state_before_can_finish(spark):
    base = staging_path(spark, "test")
    path = f"{base}/table"
    write = live.write_changes(path, "insee", ["n"], compact_every=2)
    for batch in range(3):
        write(spark.createDataFrame([("75101", batch, "a")], MESSAGE), batch)
    before = live.read_changes(spark, path, "insee", MESSAGE, ["n"])
    write(spark.createDataFrame([("75101", 3, "a")], MESSAGE), 3)  # switches
    assert [r.n for r in before.collect()] == [2] and table(spark, base) == [("75101", 3, "a")]


def test_a_failure_before_the_switch_changes_nothing(spark, monkeypatch):
    base = staging_path(spark, "test")
    path = f"{base}/table"
    write = live.write_changes(path, "insee", ["n"], compact_every=2)
    write(spark.createDataFrame([("75101", 0, "a")], MESSAGE), 0)
    with monkeypatch.context() as m:
        m.setattr(changes, "_newest", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write(spark.createDataFrame([("75101", 1, "b")], MESSAGE), 1)
    assert changes.state(spark, path).number == 0 and table(spark, base) == [("75101", 1, "b")]
    write(spark.createDataFrame([("75101", 1, "b")], MESSAGE), 1)  # the batch runs again
    assert changes.state(spark, path).number == 1 and table(spark, base) == [("75101", 1, "b")]
    write(spark.createDataFrame([("75101", 1, "other")], MESSAGE), 1)  # a snapshot holds it
    assert table(spark, base) == [("75101", 1, "b")]
    # of two that switch at once the second is too late
    old = changes.state(spark, path)
    assert not store.put_text(spark, f"{path}/_current/{old.number:020d}", "{}") and changes.state(spark, path) == old
    assert not changes.compact(spark, path, "insee", MESSAGE, ["n"])


def test_an_unfinished_batch_is_not_read(spark):
    base = staging_path(spark, "test")
    live.write_changes(f"{base}/table", "insee", ["n"])(spark.createDataFrame([("75101", 0, "a")], MESSAGE), 0)
    spark.createDataFrame([("75101", 1, "torn", dt.datetime.now())], STORED).write.parquet(f"{base}/table/changes/writer=direct/batch=1")
    assert table(spark, base) == [("75101", 0, "a")]
    assert live.read_changes(spark, f"{base}/nothing", "insee", MESSAGE, ["n"]).collect() == []


def test_two_streams_write_one_table(spark):
    """Each stream counts its own batches."""
    base = staging_path(spark, "test")
    for name in ("one", "two"):
        land(spark, f"{base}/{name}", [message("75101", 1 if name == "two" else 2, name), message("75103" if name == "one" else "75104", 5, name)])
        stream = live.read_landed(spark, f"{base}/{name}", struct(("value", T.StringType())))
        paths = (f"{base}/table", f"{base}/rejects-{name}", f"{base}/checkpoint-{name}")
        live.consume(stream, MESSAGE, "insee", ["n"], *paths, NOW, compact_every=1).awaitTermination()
    assert table(spark, base) == [("75101", 2, "one"), ("75103", 5, "one"), ("75104", 5, "two")]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_no_row_is_lost_outside_utc(spark, zone):
    """At every hour a row of 23 hours is seen, one of 25 is not, before and after a snapshot."""
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", zone)
    base = staging_path(spark, "test")
    start = dt.datetime(2026, 3, 7, tzinfo=dt.timezone.utc)  # clocks change in between
    hours = [start + dt.timedelta(hours=h) for h in range(3, 27)]
    rows = [(f"{h}-{age}", age, zone, now - dt.timedelta(hours=age)) for h, now in enumerate(hours) for age in (23, 25)]
    write = live.write_changes(f"{base}/table", "insee", ["n"], after=dt.timedelta(days=36500), compact_every=2)
    for batch in range(2):
        write(other.createDataFrame(rows[batch::2], STORED), batch)
        if batch:
            assert changes.state(other, f"{base}/table").number == 1
            for h, now in enumerate(hours):
                as_of = now if h % 2 else now.replace(tzinfo=None)
                got = live.read_changes(other, f"{base}/table", "insee", MESSAGE, ["n"], as_of=as_of)
                seen = {r.insee for r in live.lookup(got.filter(F.col("insee").startswith(f"{h}-")), "insee", as_of=as_of).select("insee").collect()}
                assert seen == {f"{h}-23"}


def test_the_queries_of_live_readings_hold_outside_utc(spark, sf_dir):
    from terrazzo.catalog import QUERIES

    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    for name in ("stream_lookup_expired", "stream_latest"):
        assert sorted(map(tuple, QUERIES[name](other, sf_dir).collect())) == sorted(map(tuple, QUERIES[name](spark, sf_dir).collect()))


def test_late_messages_go_aside_and_marks_survive_a_restart(spark):
    base = staging_path(spark, "test")
    schema = struct(("insee", T.StringType()), ("n", T.LongType()), ("at", T.LongType()))

    def run(*rows):
        land(spark, f"{base}/landed", [json.dumps({"insee": k, "n": n, "at": at}) for k, n, at in rows])
        stream = live.read_landed(spark, f"{base}/landed", struct(("value", T.StringType())))
        live.consume(
            stream, schema, "insee", ["n"], f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", NOW,
            event_time=F.timestamp_seconds("at"), delay=dt.timedelta(seconds=10), late=f"{base}/late",
        ).awaitTermination()
        late = sorted(tuple(r)[:3] for r in spark.read.schema(schema).parquet(f"{base}/late").collect())
        return late, sorted(tuple(r)[:3] for r in live.read_changes(spark, f"{base}/table", "insee", schema, ["n"]).collect())

    # within a batch nothing is late: the mark is that of the batches before
    assert run(("a", 1, 100), ("b", 1, 5)) == ([], [("a", 1, 100), ("b", 1, 5)])
    assert run(("a", 2, 89), ("b", 2, 90), ("c", 1, None)) == ([("a", 2, 89)], [("a", 1, 100), ("b", 2, 90), ("c", 1, None)])
    late, kept = run(("d", 1, 200), ("a", 3, 95))
    assert late == [("a", 2, 89)] and ("a", 3, 95) in kept
    assert run(("d", 2, 189))[0] == [("a", 2, 89), ("d", 2, 189)]
    with pytest.raises(ConfigurationError):
        live.consume(spark.range(1), schema, "insee", ["n"], "t", "r", "c", event_time=F.col("at"))


def test_expired_rows_are_not_looked_up(spark):
    base = staging_path(spark, "test")
    now = dt.datetime.now(dt.timezone.utc)
    rows = [("75101", 9, "old", now - dt.timedelta(hours=25)), ("75101", 1, "new", now - dt.timedelta(hours=1)), ("75102", 5, "old", now - dt.timedelta(hours=25))]
    live.write_changes(f"{base}/table", "insee", ["n"])(spark.createDataFrame(rows, STORED), 0)
    got = live.read_changes(spark, f"{base}/table", "insee", MESSAGE, ["n"])
    assert [tuple(r)[:3] for r in live.lookup(got, "insee").collect()] == [("75101", 1, "new")]
    assert live.lookup(got, "insee", "75101", as_of=now.replace(tzinfo=None) + dt.timedelta(days=2)).count() == 0
