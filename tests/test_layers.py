"""Silver rules, reports and jobs on hand-written rows."""

import bisect
import datetime as dt
import json
import math
import random
import threading

import pytest
from pyspark.sql import functions as F

from terrazzo.catalog import ingest
from terrazzo.catalog import tables as t
from terrazzo.errors import ConfigurationError, IngestionError, LayerError
from terrazzo.operators import aggregates, sketches
from terrazzo.plans import bronze, gold, jobs, reports, runs, silver
from terrazzo.schemas import DIMENSION, GOLD, RAW_AIR, RAW_HOUSING, RAW_SALES
from terrazzo.plans.runs import recorded, run_log
from terrazzo.sources import files, reference, sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sale(code="75101", kind="Appartement", value="100000", surface="50", rooms="2", date="2024-05-01"):
    return (date, "Vente", value, code, kind, surface, rooms)


KEPT = [
    sale(), sale(code="75120"), sale(surface="9,01", value="100000"), sale(value="10000,01", surface="10"),
    sale(value="50000", surface="100"),  # 500 exactly
    sale(value="4000000", surface="50"),  # 80000 exactly
    sale(value="49999,5", surface="100"),  # 499.995 rounds to 500
    sale(rooms="x"), sale(date="05/01/2024"),
]
DROPPED = [
    sale(code="75100"), sale(code="75121"), sale(code=None), sale(kind="Maison"), sale(surface="9"), sale(value="10000"),
    sale(value="49999", surface="100"), sale(value="4000001", surface="50"), sale(value="x"), sale(surface=""),
    sale(value="49999,4", surface="100"), sale(value="4000000,25", surface="50"),
]


def test_sales_rules(spark):
    raw = spark.createDataFrame(KEPT + DROPPED, RAW_SALES)
    got = silver.sales(raw)
    assert got.count() == len(KEPT) and silver.sales(spark.createDataFrame(DROPPED, RAW_SALES)).count() == 0
    prices = {r.prix_m2 for r in got.collect()}
    assert {500.0, 80000.0, 2000.0} <= prices
    unread = got.filter("nombre_pieces_principales is null").count(), got.filter("annee is null").count()
    assert unread == (1, 1)
    bad = silver.sale_rejects(raw).first()
    assert (bad.n_rows, bad.bad_valeur_fonciere, bad.bad_surface_reelle_bati) == (len(KEPT) + len(DROPPED), 1, 1)
    assert (bad.bad_nombre_pieces_principales, bad.bad_date_mutation) == (1, 1)


def test_price_bounds_equal_the_rounded_test(spark):
    cents = [49999.4, 49999.49, 49999.5, 49999.51, 50000.0, 8000000.0, 8000000.4, 8000000.49, 8000000.5, 8000001.0]
    df = spark.createDataFrame([sale(value=str(c / 100 * 100), surface="100") for c in cents], RAW_SALES)
    rounded = df.filter(F.round(F.col("valeur_fonciere").cast("double") / 100, 2).between(500, 80000)).count()
    assert silver.sales(df).count() == rounded


def test_typed_and_text_sales_give_the_same(spark):
    raw = spark.createDataFrame(KEPT, RAW_SALES)
    typed = raw.withColumns(
        {
            "valeur_fonciere": F.replace("valeur_fonciere", F.lit(","), F.lit(".")).cast("double"),
            "surface_reelle_bati": F.replace("surface_reelle_bati", F.lit(","), F.lit(".")).cast("double"),
        }
    )
    assert rows(silver.sales(raw)) == rows(silver.sales(typed))


def test_housing_adds_two_financings(spark):
    base = {f.name: None for f in RAW_HOUSING}
    raw = spark.createDataFrame(
        [
            {**base, "annee": "2020", "arrdt": 7, "nb_plus": 3, "nb_pluscd": 4, "nb_logmt_total": 9},
            {**base, "annee": "2020", "arrdt": 7, "nb_plus": None, "nb_pluscd": None},
            {**base, "annee": "2020", "arrdt": 21, "nb_plus": 3},
            {**base, "annee": "2020", "arrdt": None},
        ],
        RAW_HOUSING,
    )
    got = silver.housing(raw)
    assert rows(got.select("annee", "arrondissement", "nb_plus", "nb_logmt_total")) == [(2020, 7, 0, None), (2020, 7, 7, 9)]


def test_incomes_use_the_columns_present(spark):
    raw = spark.createDataFrame([("751072605", "31000,5", "x"), ("930010101", "1", "1"), ("751219999", "1", "1"), (None, "1", "1")],
                                "IRIS string, DEC_MED18 string, OTHER string")
    got = silver.incomes(raw)
    assert got.columns == ["IRIS", "arrondissement", "DEC_MED18"] and rows(got) == [("751072605", 7, 31000.5)]


def test_air_accepts_new_codes_and_empty_lists(spark, tmp_path):
    reading = {"date": "2026-06-24", "no2": "Bon", "o3": "Mauvais", "pm10": "Moyen", "pm25": "Moyen", "so2": "Bon", "indice": "Mauvais"}
    delivery = {
        "date": "2026-06-24", "nb_ok": 2, "nb_erreurs": 1, "erreurs": [{"insee": "75103", "error": "timeout"}],
        "arrondissements": [
            {"insee": "75101", "arrondissement": 1, "fetched_at": "2026-06-24", "data": {"75101": [reading, {**reading, "date": "2026-06-25"}]}},
            {"insee": "99999", "arrondissement": 2, "fetched_at": "2026-06-24", "data": {"99999": []}},
        ],
    }
    (tmp_path / "airparif_2026-06-24.json").write_text(json.dumps(delivery, ensure_ascii=False, indent=2), encoding="utf-8")
    envelopes = bronze.air(spark, str(tmp_path), "2026-06-24")
    assert envelopes.schema == RAW_AIR
    got = silver.air(envelopes)
    assert [(r.insee, r.date, r.polluants_max) for r in got.orderBy("date").collect()] == [
        ("75101", dt.date(2026, 6, 24), "o3"), ("75101", dt.date(2026, 6, 25), "o3"),
    ]
    assert bronze.air(spark, str(tmp_path), "2026-06-25") is None


# ---- reports -----------------------------------------------------------------------------

COLUMNS = (
    "arrondissement smallint, annee smallint, nb_transactions int, prix_m2_median double, nb_logements_sociaux int, "
    "revenu_median_arr double, taux_delinquance_global int, taux_delinquance_pmille double"
)
FACT = [
    (1, 2020, 10, 10000.0, 5, 30000.0, 7, 1.5), (1, 2021, 20, 11000.0, None, 30000.0, 8, None), (1, 2023, 5, 9000.0, 10, 30000.0, 9, 2.5),
    (2, 2020, None, 0.0, 1, None, None, None), (2, 2021, 0, 12000.0, 1, None, 4, 0.5), (7, 2021, 30, 14000.0, 100, 50000.0, 2, 0.25),
]


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(FACT, COLUMNS)


@pytest.fixture(scope="module")
def dim(spark):
    return reference.seed_dimension(spark).withColumn(
        "nb_residences_principales", F.when(F.col("arrondissement") == 1, 1000).when(F.col("arrondissement") == 2, 0)
    )


def test_seed(spark):
    seed = reference.seed_dimension(spark)
    assert seed.schema == DIMENSION and seed.count() == 20
    assert seed.filter("arrondissement = 7").first()[:7] == (7, "75107", "Paris 7ème Arrondissement", "75007", 4.088, 51765, 12661)
    assert reference.district_labels(spark).filter("arrondissement = 1").first().nom == "1er arr. - Louvre"


def test_kpi(fact, dim):
    got = {r.arrondissement: r for r in reports.kpi(fact, dim, 2021).collect()}
    assert list(got) == [1, 2, 7]
    assert (got[1].variation, got[1].tx_logement_sociaux) == (10.0, 0.5)
    assert (got[2].variation, got[2].tx_logement_sociaux) == (None, 0.0)  # previous price 0, no residences
    assert (got[7].variation, got[7].tx_logement_sociaux) == (None, 0.0)  # no previous year, residences unknown
    assert reports.kpi(fact, dim, 2023).first().variation is None  # 2022 is missing
    assert [r.arrondissement for r in reports.kpi(fact, dim, 2021, "75107").collect()] == [7]
    assert reports.kpi(fact, dim, 2021, "all").count() == 3
    with pytest.raises(LayerError):
        reports.require_rows(reports.kpi(fact, dim, 1999))


def test_kpi_city(fact, dim):
    row = reports.kpi_city(reports.kpi(fact, dim, 2021)).first()
    # weights 20, 1 (for 0) and 30
    assert row.prix_m2_median == round((11000 * 20 + 12000 + 14000 * 30) / 51, 2)
    assert row.variation == 10.0
    assert row.revenu_median == round((30000 * 20 + 50000 * 30) / 50, 2)
    assert row.transactions_total == 50 and row.arrondissement == 0
    assert row.taux_delinquance_pmille == 0.38  # mean of 0.5 and 0.25
    assert reports.kpi_city(reports.kpi(fact, dim, 1999)).count() == 0


def test_data_table_uses_all_years_and_population(fact, dim):
    got = {r.arrondissement: r for r in reports.data_table(fact, dim, 2021).collect()}
    assert got[1].tx_logement_sociaux == round(15 * 100.0 / (16266 / 2.2), 1)


def test_price_history(fact):
    city = rows(reports.price_history(fact))
    # a weight of zero stays zero here, a missing one counts as one
    assert city == [(2020, round(100000 / 11, 0)), (2021, round((11000 * 20 + 14000 * 30) / 50, 0)), (2023, 9000.0)]
    assert rows(reports.price_history(fact, "2")) == [(2020, 0.0), (2021, 12000.0)]


def test_splits_round_half_to_even(spark):
    shares = {"part_studio_t1": 25.0, "part_t2": 75.0, "part_t3": None, "part_t4": 0.0, "part_t5_plus": 0.0}
    df = spark.createDataFrame([(1, 2020, 10, *shares.values())], "arrondissement int, annee int, nb_transactions int, " + ", ".join(f"{c} double" for c in shares))
    got = reports.typology(df, 2020)
    assert rows(got.select("id", "count")) == [("studio_t1", 2), ("t2", 8), ("t3", 0), ("t4", 0), ("t5_plus", 0)]
    assert reports.typology(df, 2021).count() == 0


def test_map_and_lists(fact, dim):
    assert rows(reports.map_prices(fact, 2021)) == [("75101", 11000.0, 2), ("75102", 12000.0, 2), ("75107", 14000.0, 3)]
    assert reports.district_list(dim).count() == 20
    assert reports.social_housing(fact.selectExpr("*", "1 nb_plai", "1 nb_plus_pluscd", "1 nb_pls"), district=1, year=2023).count() == 1
    assert reports.composite(fact, dim, 2021).columns[-3:] == ["nom", "code_postal", "superficie_km2"]


def test_city_air_label_is_the_first_one_however_late(spark):
    table = [(f"751{n:02d}", None) for n in range(1, 20)] + [("75120", "Bon"), ("75119", "Moyen")]
    df = spark.createDataFrame(table, "insee string, air_label string")
    assert tuple(reports.city_air_label(df).first()) == ("75119", "Moyen")


# ---- jobs and sinks ----------------------------------------------------------------------


def test_writing_a_date_again_leaves_other_dates(spark, tmp_path):
    root = str(tmp_path)
    for date, n in (("2026-06-24", 3), ("2026-06-25", 5), ("2026-06-24", 2)):
        sinks.write_dated(spark.range(n), root, "t", date)
    got = files.read_layer(spark, root, "t")
    assert rows(got.groupBy("ingestion_month", "ingestion_day").count()) == [("06", "24", 2), ("06", "25", 5)]
    assert files.read_ingestion(spark, root, "t", "2026-06-25").count() == 5
    assert files.read_newest(spark, root, "t").count() == 5


def test_one_failed_delivery_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "dvf_75_2024.csv").write_text("code_commune,type_local\n75101,Appartement\n")
    log = f"{tmp_path}/runs"
    with pytest.raises(IngestionError, match="delinquance"):
        jobs.run_bronze(spark, ["delinquance", "dvf", "airparif"], str(tmp_path), f"{tmp_path}/bronze", "2026-06-24", log)
    assert rows(runs.run_log(spark, log).select("source", "statut", "nb_lignes_out")) == [
        ("airparif", "skipped", None), ("delinquance", "failed", None), ("dvf", "success", 1)
    ]
    with pytest.raises(IngestionError):
        jobs.run_silver(spark, ["delinquance"], f"{tmp_path}/bronze", f"{tmp_path}/silver", "2026-06-24", log)


def test_gold_keeps_groups_with_sales_only(spark):
    sales = silver.sales(spark.createDataFrame([sale(), sale(code="75102")], RAW_SALES))
    housing = spark.createDataFrame([(2024, 1, 5, 1, 1, 1), (2023, 1, 5, 1, 1, 1)], "annee smallint, arrondissement smallint, nb_logmt_total int, nb_plai int, nb_plus int, nb_pls int")
    got = gold.gold(sales, housing)
    assert rows(got.select("arrondissement", "annee", "nb_logements_sociaux")) == [(1, 2024, 5), (2, 2024, None)]


def test_jdbc_options(spark, monkeypatch):
    """No database runs here: only what is handed to Spark's writer is checked."""
    seen = {}
    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "options", lambda self, **o: (seen.update(o), self)[1])
    monkeypatch.setattr(writer, "option", lambda self, k, v: (seen.update({k: v}), self)[1])
    monkeypatch.setattr(writer, "mode", lambda self, m: (seen.update(mode=m), self)[1])
    monkeypatch.setattr(writer, "save", lambda self: seen.update(saved=True))
    sinks.write_jdbc(spark.range(1), "jdbc:x", "t", connections=4, user="u")
    assert seen == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": 10000, "truncate": True, "user": "u", "numPartitions": 4, "mode": "overwrite", "saved": True,
    }


def test_gold_table_has_its_declared_types(spark, tmp_path):
    sales = silver.sales(spark.createDataFrame([sale()], RAW_SALES))
    housing = spark.createDataFrame([], "annee smallint, arrondissement smallint, nb_logmt_total int, nb_plai int, nb_plus int, nb_pls int")
    crime = spark.createDataFrame([], "annee smallint, arrondissement smallint, indicateur string, nombre double, taux_pour_mille double")
    incomes = spark.createDataFrame([("751010101", 1, 3.5, 0.3, 4.0)], "IRIS string, arrondissement smallint, DEC_MED18 double, DEC_GI18 double, DEC_RD18 double")
    for name, df in (("transactions", sales), ("logements_sociaux", housing), ("delinquance", crime), ("revenus", incomes)):
        sinks.write_dated(df.coalesce(1), str(tmp_path), name, "2026-06-24")
    fact = jobs.build_gold(spark, str(tmp_path), year=2024)
    assert [f.dataType for f in fact.schema] == [f.dataType for f in GOLD] and fact.columns == GOLD.fieldNames()
    assert fact.first().taux_logements_sociaux is None and fact.count() == 1
    assert jobs.build_gold(spark, str(tmp_path), date="2026-06-24", year=2023).count() == 0


def test_command_line(spark, tmp_path, monkeypatch):
    header = "date_mutation,nature_mutation,valeur_fonciere,code_commune,type_local,surface_reelle_bati,nombre_pieces_principales,extra\n"
    (tmp_path / "dvf_75_2024.csv").write_text(header + '2024-05-01,Vente,"100000,5",75101,Appartement,50,2,x\n')
    bronze_root, silver_root = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    day = ["--source", "dvf", "--date", "2026-06-24"]
    jobs.main(["bronze", *day, "--input-path", str(tmp_path), "--output-path", bronze_root])
    jobs.main(["silver", *day, "--bronze-path", bronze_root, "--silver-path", silver_root])
    got = jobs.silver_table(spark, silver_root, "transactions", None)
    assert rows(got.select("arrondissement", "annee", "prix_m2")) == [(1, 2024, 2000.01)]
    called = {}
    monkeypatch.setattr(jobs, "run_gold", lambda *a, **k: called.update(args=a[1:], **k))
    jobs.main(["gold", "--silver-path", silver_root, "--jdbc-url", "jdbc:x", "--jdbc-user", "u", "--jdbc-password", "p", "--annee", "2024"])
    assert called["args"][:2] == (silver_root, "jdbc:x") and 2024 in called["args"] and called["user"] == "u"


def test_contract_check_of_the_gold_table(spark):
    from terrazzo.operators import contracts
    from terrazzo.schemas import GOLD_KEY

    sales = silver.sales(spark.createDataFrame([sale(), sale(code="75102")], RAW_SALES))
    fact = gold.gold(sales)
    assert contracts.duplicate_keys(fact, *GOLD_KEY).count() == 0
    declared = type(GOLD)([f for f in GOLD if f.name in fact.columns])
    assert contracts.require(fact, contracts.fits_schema(declared)) is fact


def test_update_statement():
    """The text is run by DuckDB in this process, standing in for the database."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE d (k INTEGER, a INTEGER, b VARCHAR)")
    con.execute("INSERT INTO d VALUES (1, 10, 'x'), (2, 20, 'y'), (3, NULL, 'z')")
    con.execute("CREATE TABLE d_updates (k INTEGER, a INTEGER)")
    con.execute("INSERT INTO d_updates VALUES (1, 11), (2, NULL), (3, 33), (4, 44)")
    for _ in range(2):
        con.execute(sinks.update_statement("d", "d_updates", "k", ["a"]))
        assert con.execute("SELECT * FROM d ORDER BY k").fetchall() == [(1, 11, "x"), (2, 20, "y"), (3, 33, "z")]


def test_dimension_updates(spark, tmp_path):
    areas = silver.districts(spark.createDataFrame([(7, 4.088, 51765), (25, 1.0, 1)], "arrondissement int, superficie_km2 double, population_totale int"))
    homes = silver.residences(spark.createDataFrame([("75107", "27000.9"), ("75200", "1"), ("75108", "x")], "CODGEO string, P22_RP string"))
    sinks.write_dated(areas, str(tmp_path), "arrondissements", "2026-06-24")
    sinks.write_dated(homes, str(tmp_path), "residences_principales", "2026-06-24")
    first, second = jobs.dimension_updates(spark, str(tmp_path))
    assert rows(first) == [(7, 4.088, 51765, 12663)] and rows(second) == [(7, 27000), (8, None)]
    seed = reference.seed_dimension(spark)
    updated = gold.dimension_with_residences(gold.dimension_with_areas(seed, areas), homes)
    assert updated.schema == seed.schema
    assert updated.filter("arrondissement = 7").first()[4:] == (4.088, 51765, 12663, 27000)
    assert rows(updated.filter("arrondissement > 8")) == rows(seed.filter("arrondissement > 8"))


def test_a_document_of_several_codes_gives_its_own_label(spark):
    document = '{"data": {"75101": [{"indice": "Bon"}], "75102": [{"indice": "Moyen"}]}}'
    df = spark.createDataFrame([("75102", document), ("75103", document), ("75101", document)], "insee string, document string")
    assert {r.insee: r.air_label for r in reports.air_labels(df).collect()} == {"75101": "Bon", "75102": "Moyen", "75103": "Bon"}


def test_sources_side_by_side(spark, tmp_path, monkeypatch):
    """Runs overlap in the run log, every source has its own pool, and the errors of all are told."""
    together, pools = threading.Barrier(3), []

    def feed(spark_, source, folder, root, date, runs):
        with recorded(spark_, runs, f"bronze_{source}", source, "bronze"):
            together.wait(60)  # passes only if three run at once
            pools.append(spark_.sparkContext.getLocalProperty("spark.scheduler.pool"))
            if source != "b":
                raise IngestionError(f"{source} is broken")

    monkeypatch.setattr(jobs, "feed", feed)
    log = f"{tmp_path}/runs"
    with pytest.raises(IngestionError, match="a: a is broken; c: c is broken"):
        jobs.run_bronze(spark, ["a", "b", "c"], "in", "out", "2026-06-24", log, at_once=3)
    assert sorted(pools) == ["a", "b", "c"] and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    got = run_log(spark, log).collect()
    assert sorted((r.source, r.statut) for r in got) == [("a", "failed"), ("b", "success"), ("c", "failed")]
    assert max(r.started_at for r in got) < min(r.finished_at for r in got)
    with pytest.raises(ConfigurationError):
        jobs.run_bronze(spark, ["a"], "in", "out", "2026-06-24", at_once=0)


def test_both_kpi_reports_come_from_one_aggregate(spark, sf_dir):
    fact, dim = t.stored_gold(spark, sf_dir), t.dimension(spark, sf_dir)
    both = reports.kpi_sets(fact, dim, 1998)
    one = reports.kpi(fact, dim, 1998)
    districts, city = reports.kpi_districts(both, one), reports.kpi_whole_city(both)
    assert districts.dtypes == one.dtypes and [tuple(r) for r in districts.collect()] == [tuple(r) for r in one.collect()]
    want = reports.kpi_city(one)
    assert [tuple(r) for r in city.select(*want.columns).collect()] == [tuple(r) for r in want.collect()]
    text = both._jdf.queryExecution().executedPlan().toString()
    assert text.count("Expand") == 1 and text.count("FileScan") <= 2
    # without sales in any district: the number of rows
    none = fact.withColumn("nb_transactions", F.lit(None).cast("bigint"))
    assert reports.kpi_whole_city(reports.kpi_sets(none, dim, 1998)).first().transactions_total == one.count()
    assert reports.kpi_sets(fact, dim, 1900).collect() == []


def test_stored_sketches_answer_for_districts_city_and_years(spark, tmp_path):
    rng = random.Random(1)
    values = [(d, y, rng.lognormvariate(9, 0.4), 30.0) for d in (1, 2, 3) for y in (2019, 2020, 2021) for _ in range(4000)] + [(4, 2020, None, None), (4, 2021, math.nan, 1.0)]
    sales = spark.createDataFrame(values, "arrondissement int, annee int, prix_m2 double, surface_reelle_bati double").repartition(7)
    sketches.sketched(sales).write.parquet(f"{tmp_path}/s")
    stored = spark.read.parquet(f"{tmp_path}/s")
    for district, years in ((None, None), ("75102", None), (None, (2020, 2021)), (3, (2019, 2019))):
        mine = sorted(p for d, y, p, _ in values if p is not None and p == p and (district in (None, d) or district == f"751{d:02d}") and (years is None or years[0] <= y <= years[1]))
        got = reports.price_quantiles(stored, {"q1": 0.25, "q2": 0.5, "q9": 0.9}, district, years).first()
        assert got.n == len(mine)
        for share, value in ((0.25, got.q1), (0.5, got.q2), (0.9, got.q9)):
            assert abs(bisect.bisect(mine, value) / len(mine) - share) <= 2 * sketches.rank_error() + 1 / len(mine)
    assert tuple(reports.price_quantiles(stored, {"q": 0.5}, 4).first()) == (0, None)
    assert tuple(reports.price_quantiles(stored.limit(0), {"q": 0.5}).first()) == (0, None)


def test_distinct_counts_need_no_shuffle_of_values(spark):
    df = spark.range(300_000).select((F.col("id") % 90_000).alias("many"), (F.col("id") % 12).alias("few"), F.lit(None).cast("string").alias("none"))
    figures = aggregates.distinct_figures("many", "few", "none")
    told = df.agg(*[c.alias(n) for n, c in figures.items()])
    text = told._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "Expand" not in text
    got = told.first()
    assert abs(got.many_distinct - 90_000) <= 4 * aggregates.distinct_error() * 90_000 and (got.few_distinct, got.none_distinct) == (12, 0)


def test_sales_files_take_one_pass(spark, monkeypatch):
    """Both folders of sales come from one reading of the joined tables; a sale without a date is in neither."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def date(text):
        read.add(1)
        return text

    dates = ["1996-02-01", "1997-12-31", "1998-01-01", "1999-05-05", None]
    names = [f.name for f in RAW_SALES]
    rows = spark.createDataFrame([(d, *[f"{n}{i}" for n in names[1:]]) for i, d in enumerate(dates)], RAW_SALES)
    counted = rows.withColumn("date_mutation", date.asNondeterministic()("date_mutation"))
    monkeypatch.setattr(ingest.t, "raw_sales", lambda spark, sf, as_text: counted)
    folder = ingest._sales_files(spark, "none")
    assert read.value == len(dates)
    found = bronze.sales(spark, folder, ingest.DATE)
    assert found.columns == names
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.filter("date_mutation is not null").collect()))
    years = [{r.date_mutation[:4] for r in files.read_csv(spark, f"{folder}/{bronze.SALES_FILES.replace('*', f'*{part}')}").collect()} for part in "ab"]
    assert years == [{"1996", "1997"}, {"1998", "1999"}]


def test_silver_side_by_side(spark, monkeypatch):
    """Two refinements that wait for one another both run; the first error is raised at the end, when all others are done."""
    met, done = threading.Barrier(2, timeout=60), []

    def refine(spark, source, *rest):
        if source == "a":
            raise LayerError("a failed")
        met.wait()
        done.append(source)

    monkeypatch.setattr(jobs, "refine", refine)
    with pytest.raises(LayerError, match="a failed"):
        jobs.run_silver(spark, ["a", "b", "c"], "in", "out", "2026-06-24", at_once=3)
    assert sorted(done) == ["b", "c"]
