"""Gold brought to a later ingestion against a full build."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrazzo.plans import gold, increments, jobs
from terrazzo.schemas import GOLD_KEY, SILVER
from terrazzo.sources.sinks import write_dated

OLD, NEW = "2026-06-23", "2026-06-24"


def sale(district, year, price, surface=50.0, rooms=2):
    day = dt.date(year, 5, 1) if year else None
    return (day, year, district, "75101", price * surface, surface, rooms, "Appartement", price, "Vente")


def built(spark, table, rows):
    return spark.createDataFrame(rows, SILVER[table])


def income(district, median):
    return tuple([f"751{district:02}0101", district, median] + [0.3] * (len(SILVER["revenus"]) - 3))


BEFORE = {
    "transactions": [sale(1, 2023, 9000.0), sale(1, 2024, 9500.0), sale(2, 2023, 8000.0), sale(3, 2023, 7000.0), sale(4, 2023, 6000.0), sale(5, 2023, 5000.0)],
    "logements_sociaux": [(2023, 2, "a", "75002", 10, 1, 2, 3, "m", "n")],
    "delinquance": [(2023, 3, "75103", "Cambriolages de logement", 5.0, 1.5, "u", "diff")],
    "revenus": [income(4, 20000.0), income(1, 30000.0)],
}
# 1/2023 gets a sale and 1/2024 loses its only one; housing of 2, crime of 3 and incomes of 4 change; 5 stays; 6 is new
AFTER = {
    "transactions": [sale(6, 2024, 6500.0), sale(1, 2023, 9900.0), *BEFORE["transactions"][2:], BEFORE["transactions"][0]],
    "logements_sociaux": [(2023, 2, "a", "75002", 12, 1, 2, 3, "m", "n")],
    "delinquance": [(2023, 3, "75103", "Cambriolages de logement", 6.0, 1.75, "u", "diff")],
    "revenus": [income(4, 21000.0), income(1, 30000.0)],
}


def sources(spark, rows):
    names = {"sales": "transactions", "housing": "logements_sociaux", "crime": "delinquance", "incomes": "revenus"}
    return {name: built(spark, table, rows[table]) for name, table in names.items()}


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_only_touched_groups_are_computed_again(spark):
    old, new = sources(spark, BEFORE), sources(spark, AFTER)
    touched = increments.touched_groups(increments.silver_prints(**old), increments.silver_prints(**new))
    assert plain(touched) == [(1, 2023), (1, 2024), (2, 2023), (3, 2023), (4, 2023), (6, 2024)]
    stored = gold.gold(**old)
    full = gold.gold(**new)
    assert plain(increments.refreshed_gold(stored, touched, **new)) == plain(full)
    # a mark in the stored table shows which rows were not computed again
    marked = stored.withColumn("nb_transactions", F.lit(-1).cast("long"))
    again = increments.refreshed_gold(marked, touched, **new)
    assert [(r.arrondissement, r.annee) for r in again.where("nb_transactions = -1").collect()] == [(5, 2023)]
    # nothing new, nothing computed; all new, a full build; the last ingestion empty, nothing left
    prints = increments.silver_prints(**new)
    assert increments.touched_groups(prints, prints).count() == 0
    none = {name: df.limit(0) for name, df in new.items()}
    empty = increments.silver_prints(**none)
    all_new = increments.touched_groups(empty, prints)
    assert plain(increments.refreshed_gold(full.limit(0), all_new, **new)) == plain(full)
    assert increments.refreshed_gold(full, increments.touched_groups(prints, empty), **none).count() == 0


def test_prints_see_repeats_nulls_and_no_order(spark):
    rows = [(1, 2020, "a"), (1, 2020, "b"), (None, 2020, "a"), (2, None, None)]
    kind = "arrondissement int, annee int, x string"
    table = lambda r: spark.createDataFrame(r, kind)
    was = increments.prints(table(rows), *GOLD_KEY)
    seen = lambda r: plain(increments.changed(was, increments.prints(table(r), *GOLD_KEY), *GOLD_KEY))
    assert seen(rows[::-1]) == []
    # two equal rows more, which a sum without a count or an exclusive or would miss
    assert seen([*rows, rows[0], rows[0]]) == [(1, 2020)]
    assert seen([rows[0], (1, 2020, None), *rows[2:]]) == [(1, 2020)]
    assert seen(rows[:2]) == [(2, None), (None, 2020)]
    groups = spark.createDataFrame([(None, 2020), (2, None)], "arrondissement int, annee int")
    assert plain(increments.within(table(rows), groups, *GOLD_KEY)) == [(2, None, None), (None, 2020, "a")]


def test_touched_keys_reach_the_scan(spark, tmp_path):
    built(spark, "transactions", BEFORE["transactions"]).write.parquet(f"{tmp_path}/sales")
    groups = spark.createDataFrame([(1, 2024), (2, 2023)], "arrondissement smallint, annee smallint")
    part = increments.within(spark.read.parquet(f"{tmp_path}/sales"), groups, *GOLD_KEY)
    plan = part._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "In(arrondissement" in pushed and "In(annee" in pushed
    assert plain(part.select(*GOLD_KEY)) == [(1, 2024), (2, 2023)]


@pytest.mark.parametrize("date", [NEW, None])
def test_the_job_keeps_what_is_not_touched(spark, tmp_path, date):
    for table in BEFORE:
        write_dated(built(spark, table, BEFORE[table]), str(tmp_path), table, OLD)
        write_dated(built(spark, table, AFTER[table]), str(tmp_path), table, NEW)
    jobs.build_gold(spark, str(tmp_path), OLD).write.parquet(f"{tmp_path}/gold")
    stored = spark.read.parquet(f"{tmp_path}/gold")
    got = jobs.refresh_gold(spark, str(tmp_path), stored, OLD, date)
    full = jobs.build_gold(spark, str(tmp_path), NEW)
    assert got.schema.simpleString() == full.schema.simpleString()
    assert plain(got.drop("computed_at")) == plain(full.drop("computed_at"))
    moment = {(r.arrondissement, r.annee): r.computed_at for r in stored.collect()}
    kept = {(r.arrondissement, r.annee) for r in got.collect() if moment.get((r.arrondissement, r.annee)) == r.computed_at}
    assert kept == {(5, 2023)}
