"""What the physical plans look like."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terrazzo.catalog import tables as t
from terrazzo.errors import IngestionError
from terrazzo.operators import aggregates
from terrazzo.operators.exact import exact_totals
from terrazzo.operators.quantiles import exact_quantiles
from terrazzo.schemas import INGESTION_DATE
from terrazzo.session import staged, staging_path
from terrazzo.sources import files, sinks, store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sales_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(t.sales(spark, sf_dir))
    assert re.search(r"GreaterThan\(l_extendedprice,10000", text)
    assert "l_discount" not in text and "o_totalprice" not in text


def test_member_filter_is_pushed(spark, sf_dir):
    path = staging_path(spark, "crime")
    t.raw_crime(spark, sf_dir).write.parquet(path)
    assert "In(CODGEO_2025" in plan(files.read_members(spark, path, "CODGEO_2025", ["75101", "75102"]))


def test_an_ingestion_date_prunes_partitions(spark, tmp_path):
    """Only the folder of the date is listed and read."""
    for date in ("2026-06-23", "2026-06-24"):
        sinks.write_dated(spark.range(3), str(tmp_path), "t", date)
    df = files.read_ingestion(spark, str(tmp_path), "t", "2026-06-24")
    assert "InMemoryFileIndex(1 paths)" in plan(df) and df.count() == 3
    assert df.inputFiles() and all("ingestion_day=24" in f for f in df.inputFiles())


@pytest.mark.parametrize("build", [aggregates.crime_rates, aggregates.housing_totals])
def test_one_shuffle_per_source(spark, sf_dir, build):
    source = staged(t.crime(spark, sf_dir) if build is aggregates.crime_rates else t.housing(spark, sf_dir), "silver")
    # exact sums of any size combine the bins of a group once more: one row for each group and bin, already aggregated
    text = plan(build(source))
    assert text.count("Exchange hashpartitioning") == (2 if build is aggregates.crime_rates else 1)
    assert "partial_sum" in text.split("Exchange hashpartitioning")[-1]


def test_sketched_sales_are_one_shuffle(spark, sf_dir):
    sales = staged(t.sales(spark, sf_dir), "sales")
    assert plan(aggregates.sale_indicators(sales, accuracy=1000)).count("Exchange hashpartitioning") == 1


def test_exact_quantiles_shuffle_counts_only(spark, sf_dir):
    sales = staged(t.sales(spark, sf_dir), "sales")
    df = exact_quantiles(sales, ("arrondissement", "annee"), aggregates.SALE_QUANTILES)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2 and "ReusedExchange" in final
    assert all("hashpartitioning" in line for line in final.splitlines() if " Exchange " in line)


def test_gold_joins_the_sales_once(spark, sf_dir, monkeypatch):
    """All reports read one gold table; the sales below it are joined and cleaned by one job, not by each of the passes over them."""
    written = []
    monkeypatch.setattr(t, "_stored", {})
    monkeypatch.setattr(t, "staged", lambda df, name: written.append((name, plan(df))) or staged(df, name))
    got = t.stored_gold(spark, sf_dir)
    assert sum(text.split("== Initial Plan ==")[0].count("l_extendedprice") > 0 for _, text in written) == 1
    assert [name for name, _ in written] == ["sales", "gold"]
    want = t.gold(spark, sf_dir, "housing", "crime", "incomes")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_exact_sums_are_short_enough_to_be_compiled(spark, sf_dir):
    """The JVM compiles no method beyond 8,000 bytes; what runs for every row must stay below."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sums = {f"s{i}": F.col("taux_pour_mille") * (i + 1) for i in range(6)}
        rates = aggregates.crime_rates(t.crime(spark, sf_dir), burglary=t.BURGLARY, violence=t.VIOLENCE)
        for df in (rates, exact_totals(t.crime(spark, sf_dir), ["arrondissement", "annee"], sums)):
            stages = df._jdf.queryExecution().debug().codegenToSeq()
            sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_newest_date_is_found_without_reading(spark, tmp_path):
    for date in ("2026-06-24", "2026-06-25", "2025-12-31"):
        sinks.write_dated(spark.range(3), str(tmp_path), "t", date)
    df = files.read_newest(spark, str(tmp_path), "t")
    assert "InMemoryFileIndex(1 paths)" in plan(df) and df.count() == 3
    assert df.inputFiles() and all("ingestion_month=06/ingestion_day=25" in f for f in df.inputFiles())
    assert tuple(df.select(*INGESTION_DATE).first()) == ("2026", "06", "25")
    assert list(files.ingestion_dates(spark, str(tmp_path), "t")) == ["2026-06-25", "2026-06-24", "2025-12-31"]


def test_ten_thousand_dates_cost_three_listings(spark, tmp_path, monkeypatch):
    root = tmp_path / "t"
    for n in range(10_000):
        (root / f"ingestion_year={1990 + n // 360}" / f"ingestion_month={n // 30 % 12 + 1:02d}" / f"ingestion_day={n % 30 + 1:02d}").mkdir(parents=True)
    (root / "ingestion_year=2099" / "ingestion_month=01").mkdir(parents=True)  # no day below
    listed, folders = [], store.folders
    monkeypatch.setattr(store, "folders", lambda s, path: listed.append(path) or folders(s, path))
    assert files.newest_date(spark, str(tmp_path), "t") == "2017-10-10"
    assert len(listed) == 1 + 2 + 2 and not any("ingestion_day" in path for path in listed)


def test_dates_without_rows_and_tables_without_dates(spark, tmp_path):
    sinks.write_dated(spark.range(3), str(tmp_path), "t", "2026-06-24")
    none = files.read_ingestion(spark, str(tmp_path), "t", "2026-06-23")
    assert none.columns == ["id", *INGESTION_DATE] and none.count() == 0
    (tmp_path / "bare").mkdir()
    assert files.newest_date(spark, str(tmp_path), "bare") is None and files.newest_date(spark, str(tmp_path), "gone") is None
    assert files.read_newest(spark, str(tmp_path), "bare", spark.range(1).schema).count() == 0
    with pytest.raises(IngestionError):
        files.required(lambda: files.read_ingestion(spark, str(tmp_path), "gone", "2026-06-24"))
    with pytest.raises(IngestionError):
        files.required(lambda: files.read_newest(spark, str(tmp_path), "gone"))


def test_reports_over_stored_gold_start_no_job(spark, sf_dir):
    reports = [run for name, run in entry.queries().items() if name.startswith("report_")]
    for run in reports:  # gold is built, and the schemas of the test tables are looked up
        run(spark, sf_dir)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    for run in reports:
        run(spark, sf_dir)
    jobs = tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")
    assert list(jobs) == []


def test_no_cross_joins_and_no_row_python(spark, sf_dir):
    for name, run in entry.queries().items():
        if name.startswith(("gold_", "report_", "agg_", "join_", "window_")):
            text = plan(run(spark, sf_dir))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
            assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_latest_combines_before_the_shuffle(spark, sf_dir):
    from terrazzo.operators.upserts import latest_per_key

    events = t.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    text = plan(latest_per_key(events, "user_id", ["event_id"]))
    assert "partial_max_by" in text and text.count("Exchange hashpartitioning") == 1
