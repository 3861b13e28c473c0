"""Operators against brute force on small hand-written tables."""

import datetime as dt
import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.errors import ConfigurationError, ContractError, IngestionError
from terrazzo.functions import codes, numbers
from terrazzo.operators import aggregates, contracts, quantiles, upserts, windows
from terrazzo.operators.exact import exact_totals
from terrazzo.operators.quantiles import exact_quantiles, value_band
from terrazzo.plans import jobs
from terrazzo.schemas import struct
from terrazzo.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def quantile_disc(values, p):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(p * len(ordered))) - 1] if ordered else None


# ---- quantiles ---------------------------------------------------------------------------

PROBABILITIES = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0}


def check_quantiles(spark, table):
    df = spark.createDataFrame(table, "k string, v double")
    wanted = {name: ("v", p) for name, p in PROBABILITIES.items()}
    got = {r.k: tuple(r[n] for n in PROBABILITIES) for r in exact_quantiles(df, ("k",), wanted).collect()}
    groups = {}
    for k, v in table:
        if v is not None and not math.isnan(v):
            groups.setdefault(k, []).append(v)
    assert got == {k: tuple(quantile_disc(vs, p) for p in PROBABILITIES.values()) for k, vs in groups.items()}


def test_quantiles_with_a_group_that_holds_most_rows(spark):
    rng = random.Random(1)
    table = [("hot", round(rng.lognormvariate(8, 1), 2)) for _ in range(5000)]
    table += [("hot", 1234.5)] * 2500  # one value holds a third
    table += [("one", -3.0), (None, 1.0), (None, 2.0), ("none", None), ("none", float("nan"))]
    check_quantiles(spark, table)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(allow_nan=False, allow_infinity=False, width=32)), min_size=1, max_size=40))
def test_quantiles_of_any_values(spark, table):
    check_quantiles(spark, table)


def test_bands_are_monotone(spark):
    values = [-1e300, -80000.0, -1.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 500.0, 80000.0, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(value_band(F.col("v")))
    bands = [r[0] for r in df.collect()]
    assert bands == sorted(bands) and len(set(bands)) >= 8


SALES = "arrondissement smallint, annee int, type_local string, prix_m2 double, surface_reelle_bati double, nombre_pieces_principales int"


def test_sale_indicators_exact_and_sketched_agree_on_small_groups(spark):
    rng = random.Random(2)
    table = [
        (d, y, "Appartement", round(rng.uniform(500, 80000), 2), float(rng.randint(10, 150)), rng.choice([None, 0, 1, 2, 3, 4, 5, 9]))
        for d in (1, 2, 20) for y in (2020, 2021) for _ in range(50)
    ]
    df = spark.createDataFrame(table, SALES)
    exact = aggregates.sale_indicators(df)
    sketched = aggregates.sale_indicators(df, accuracy=10000).select(*exact.columns)
    assert rows(exact) == rows(sketched)
    for r in exact.collect():
        assert r.prix_m2_q1 <= r.prix_m2_median <= r.prix_m2_q3
        surfaces = [r[c] for c in exact.columns if c.startswith("part_surf")]
        assert abs(sum(surfaces) - 100) < 0.1


def test_category_share_is_null_without_the_category(spark):
    df = spark.createDataFrame([(1, 2020, "Maison"), (1, 2020, "Maison"), (1, 2021, "Appartement"), (1, 2021, "Maison")], "d int, y int, t string")
    got = aggregates.category_share(df, ("d", "y"), F.col("t") == "Appartement", "share")
    assert rows(got) == [(1, 2020, None), (1, 2021, 50.0)]


def test_crime_kinds(spark):
    table = [
        (1, 2020, "cambriolages de logement", 10.0, 1.5), (1, 2020, "coups et blessures", 5.0, 0.25),
        (1, 2020, "autres violences", 1.0, 0.25), (1, 2021, "Violences", 2.0, 0.04), (1, 2021, None, 2.0, 0.01),
    ]
    df = spark.createDataFrame(table, "arrondissement smallint, annee smallint, indicateur string, nombre double, taux_pour_mille double")
    assert rows(aggregates.crime_rates(df)) == [(1, 2020, 16, 2.0, 1.5, 0.5), (1, 2021, 4, 0.1, None, None)]
    relaxed = aggregates.crime_rates(df, ignore_case=True).filter("annee = 2021").first()
    assert relaxed.taux_violences_pmille == 0.04


def test_weighted_mean_rules(spark):
    df = spark.createDataFrame([("a", 10.0, 3), ("a", 20.0, None), ("a", 30.0, 0), ("a", None, 100), ("b", None, 1)], "k string, v double, w int")
    got = aggregates.means(df, ["k"], weighted={"m": (F.col("v"), F.col("w"))}).join(df.groupBy("k").agg(aggregates.total_or_rows(F.col("w")).alias("n")), "k")
    # (10*3 + 20*1 + 30*1) / 5
    assert rows(got) == [("a", 16.0, 103), ("b", None, 1)]


# ---- windows -----------------------------------------------------------------------------

YEARS = [(1, 2018, 100.0), (1, 2019, 110.0), (1, 2021, 121.0), (2, 2018, 0.0), (2, 2019, 5.0), (3, 2019, None), (3, 2020, 7.0)]


def test_yearly_change_needs_the_year_before(spark):
    df = spark.createDataFrame(YEARS, "arrondissement int, annee int, v double")
    got = df.select("arrondissement", "annee", windows.yearly_change("v").alias("c"))
    assert rows(got) == [(1, 2018, None), (1, 2019, 10.0), (1, 2021, None), (2, 2018, None), (2, 2019, None), (3, 2019, None), (3, 2020, None)]


def test_totals_count_null_as_zero(spark):
    df = spark.createDataFrame(YEARS, "arrondissement int, annee int, v double")
    got = df.select("arrondissement", "annee", windows.running_total("v").alias("r"), windows.all_years_total("v").alias("a"))
    assert rows(got.filter("arrondissement in (1, 3)")) == [
        (1, 2018, 100.0, 331.0), (1, 2019, 210.0, 331.0), (1, 2021, 331.0, 331.0), (3, 2019, 0.0, 7.0), (3, 2020, 7.0, 7.0)
    ]


def test_scaling(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("c", 0.2), ("c", None)], "k string, v double")
    assert rows(df.filter("k <> 'c'").select("k", windows.min_max_scaled("v", "k"))) == [("a", 0.0), ("a", 1.0), ("b", 0.0)]
    assert rows(df.select("k", windows.bar_scaled("v", "k"))) == [("a", 1 / 3), ("a", 1.0), ("b", 1.0), ("c", 0.0), ("c", 0.2)]
    shares = df.select("k", windows.share_of_total("v", "k"))
    assert rows(shares) == [("a", 0.25), ("a", 0.75), ("b", 1.0), ("c", 1.0), ("c", None)]


def test_comparison(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, 20.0, 0.5), (3, 99.0, 9.0)], "d int, x double, y double")
    got = windows.compared(df, "d", 1, 2, ["x", "y"])
    assert rows(got) == [("x", 10.0, 20.0, 0.5, 1.0), ("y", 0.0, 0.5, 0.0, 0.5)]
    with pytest.raises(ValueError):
        windows.compared(df, "d", 1, 1, ["x"])


# ---- upserts -----------------------------------------------------------------------------


def test_update_matched_keeps_unmatched_and_never_inserts(spark):
    table = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", None)], "k int, n string, v int")
    new = spark.createDataFrame([(1, 11), (3, 33), (4, 44), (2, None)], "k int, w long")
    assert rows(upserts.update_matched(table, new, "k", {"v": "w"})) == [(1, "a", 11), (2, "b", 20), (3, "c", 33)]


def test_upsert_is_idempotent(spark):
    table = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, n string, v int")
    new = spark.createDataFrame([(2, "x", None), (3, "c", 30)], "k int, n string, v int")
    once = upserts.upsert(table, new, "k", ["v"])
    assert rows(once) == [(1, "a", 10), (2, "b", None), (3, "c", 30)]
    assert rows(upserts.upsert(once, new, "k", ["v"])) == rows(once)


def test_latest_per_key_breaks_ties(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t0, 1, "x"), ("a", t0, 2, "y"), ("b", t0, 1, "z")], "k string, ts timestamp, id int, v string")
    assert rows(upserts.latest_per_key(df, "k", ["ts", "id"])) == [("a", t0, 2, "y"), ("b", t0, 1, "z")]


# ---- contracts ---------------------------------------------------------------------------


def test_contracts(spark):
    df = spark.createDataFrame([(1, "ok", 1.5), (1, "bad", 100.0), (2, None, None)], "k int, s string, v double")
    parents = spark.createDataFrame([(1,), (1,)], "p int")
    assert rows(contracts.duplicate_keys(df, "k")) == [(1, 2)]
    assert rows(contracts.orphans(df, parents, "k", "p").select("k")) == [(2,)]
    declared = T.StructType([T.StructField("v", T.DecimalType(3, 1))])
    rules = contracts.not_null("v") | contracts.one_of("s", ["ok"]) | contracts.fits_schema(declared, {"s": 2})
    assert rows(contracts.violations(df, rules)) == [("s too long", 1), ("s unknown", 1), ("v is null", 1), ("v too wide", 1)]
    with pytest.raises(ContractError, match="v is null: 1 rows"):
        contracts.require(df, contracts.not_null("v"))
    assert contracts.require(df, contracts.not_null("k")) is df


def test_evolved(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    declared = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("a", T.ShortType()), T.StructField("d", T.StringType())])
    got = contracts.evolved(df, declared, {"c": 2018})
    assert got.dtypes == [("c", "int"), ("a", "smallint"), ("d", "string")] and rows(got) == [(2018, 1, None)]


# ---- files -------------------------------------------------------------------------------


def test_csv_files_in_another_column_order_fail(spark, tmp_path):
    (tmp_path / "s_1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "s_2.csv").write_text("b,a\n2,1\n")
    assert rows(files.read_csv(spark, f"{tmp_path}/s_1.csv")) == [("1", "2")]
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, f"{tmp_path}/s_*.csv").collect()


def test_missing_inputs(spark, tmp_path):
    read = lambda: spark.read.parquet(f"{tmp_path}/nothing")
    assert files.optional(read) is None
    with pytest.raises(IngestionError):
        files.required(read)


def test_find_column(spark):
    df = spark.createDataFrame([("1", "75101", "9")], ["N_INSEE Num", " Num ", "Surface"])
    assert files.find_column(files.trimmed_header(df), having="Num", lacking="INSEE") == "Num"
    with pytest.raises(IngestionError):
        files.find_column(df, having="Zone", lacking="INSEE")


def test_short_delivery_of_pages(spark):
    pages = spark.createDataFrame([(3, [("a",)]), (3, [("b",)])], "total_count int, results array<struct<x:string>>")
    assert rows(files.page_totals(pages)) == [(2, 3, False)]
    assert rows(files.records_of_pages(pages)) == [("a",), ("b",)]


def _raises(df, text):
    with pytest.raises(Exception, match=text):
        df.collect()


def test_values_that_do_not_fit_raise(spark):
    declared = struct(("k", T.IntegerType()), ("v", T.DecimalType(5, 2)))
    good = spark.createDataFrame([(1, 999.994), (2, None)], "k long, v double")
    assert [float(r.v) if r.v is not None else None for r in contracts.evolved(good, declared).orderBy("k").collect()] == [999.99, None]
    wide = spark.createDataFrame([(3_000_000_000, 1.0)], "k long, v double")
    _raises(contracts.evolved(wide, declared), "k does not fit")
    _raises(contracts.evolved(spark.createDataFrame([(1, 1e5)], "k long, v double"), declared), "v does not fit")
    assert contracts.evolved(wide, declared, strict=False).first().k is None
    assert {r.rule: r.n_broken for r in contracts.misfits(wide, declared).collect()} == {"k too wide": 1, "v too wide": 0}


def test_keys_are_unique_and_rules_hold_where_asked(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    assert contracts.unique(df, "k", "v").count() == 2
    _raises(contracts.unique(df, "k"), "more than one row")
    assert contracts.enforced(df, contracts.one_of("v", [1, 2])).count() == 2
    _raises(contracts.enforced(df, contracts.one_of("v", [1])), "v unknown")


def test_repeated_updates(spark):
    table = spark.createDataFrame([(1, 10)], "k int, v int")
    twice = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "k int, v int, at int")
    assert upserts.update_matched(table, twice, "k", {"v": "v"}, order=["at"]).collect() == [(1, 12)]
    assert upserts.upsert(table, twice, "k", ["v"], order=["at"]).collect() == [(1, 12)]
    _raises(upserts.update_matched(table, twice, "k", {"v": "v"}), "several rows")
    _raises(upserts.upsert(table, twice, "k", ["v"]), "several rows")


@pytest.mark.parametrize("split", [3, 100_000])
def test_quantiles_at_every_magnitude(spark, split):
    rng = random.Random(split)
    values = [0.0, -0.0, float("inf"), float("-inf"), float("inf"), 5e-324, -5e-324, 1.7e308, -1.7e308]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-320, 300) for _ in range(300)] + [1 + i * 1e-12 for i in range(200)]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None), ("a", float("nan"))], "k string, v double")
    wanted = {f"p{i}": ("v", i / 20) for i in range(21)}
    got = quantiles.exact_quantiles(df, ("k",), wanted, split=split).first()
    ordered = sorted(values)
    for i in range(21):
        assert got[f"p{i}"] == ordered[max(1, math.ceil(i / 20 * len(values) - 1e-9)) - 1]


def test_bands_follow_the_order_and_stay_small(spark):
    small = [i * 1e-8 for i in range(1, 100_000)]
    df = spark.createDataFrame([(v,) for v in small], "v double").select("v", quantiles.value_band(F.col("v")).alias("b"))
    assert df.groupBy("b").count().agg(F.max("count")).first()[0] < 600
    ordered = [float("-inf"), -1e300, -1.0, -1e-300, 0.0, 1e-320, 1e-7, 1.0, 1.5, 1e300, float("inf")]
    bands = [r.b for r in spark.createDataFrame([(i, v) for i, v in enumerate(ordered)], "i int, v double").orderBy("i").select(quantiles.value_band(F.col("v")).alias("b")).collect()]
    assert bands == sorted(set(bands))


def test_sums_of_any_size(spark):
    df = spark.createDataFrame([(4e-07, 1.0, 10_000.0, 10**9)] * 10, "s double, w double, p double, n long")
    row = aggregates.means(df, [], weighted={"m": (F.col("p"), F.col("n"))}, simple={"s": F.col("s") * 1e10}).first()
    assert tuple(row) == (10_000.0, 4000.0)
    assert exact_totals(df, [], {"s": F.col("s"), "p": F.col("p") * F.col("n")}).first()[0::2] == (4e-06, 1e14)


def test_exact_totals_are_the_nearest_doubles(spark):
    """Against fractions, at every magnitude, in any order and any partitions."""
    rng = random.Random(11)
    groups = {
        "tiny": [4e-13] * 2, "huge": [1e27] * 2, "both": [1e27, 4e-13, -1e27], "rest": [1e27 + 2e11, -1e27, 5.0], "negative": [-1e27, 4e-13, -5e300],
        "over": [1.7e308] * 2, "least": [5e-324] * 3, "nan": [1.0, math.nan, 3.0], "none": [None, math.nan], "zero": [1e300, -1e300], "decimal": [0.1] * 10 + [0.05],
    }
    for i in range(60):
        groups[f"r{i}"] = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.choice([rng.randint(-320, 300), rng.randint(-20, 20)]) for _ in range(rng.randint(1, 12))]
    rows = [(k, v) for k, values in groups.items() for v in values]
    rng.shuffle(rows)
    # a double counts as the text that Spark gives it
    said = {r.v: r.t for r in spark.createDataFrame(rows, "k string, v double").select("v", F.col("v").cast("string").alias("t")).collect()}
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
        got = {r.k: (r.v, r.v_count) for r in exact_totals(df, ["k"], {"v": F.col("v")}).collect()}
        for k, values in groups.items():
            numbers_ = [v for v in values if v is not None and not math.isnan(v)]
            total = sum(Fraction(Decimal(said[v])) for v in numbers_)
            try:
                want = float(total)
            except OverflowError:
                want = math.inf if total > 0 else -math.inf
            assert got[k] == (want if numbers_ else None, len(numbers_)), k


def test_millionths_and_other_values_add_up(spark):
    """Values counted as whole millionths, beside ones of more places and of other magnitudes; halves of negative ones too."""
    rng = random.Random(5)
    groups = {
        "edge": [999_999_999.999999, 1e9, -1e9, -999_999_999.999999, 0.000001], "places": [0.1234567, 0.123456, -0.1234567], "zero": [-0.0, 0.0],
        "odd": [16.777215, -16.777216, 16.777217, -0.000001], "mixed": [1e27, 0.25, -1e27, 0.5, 1e-13], "null": [None, 2.5, math.nan, -2.5],
    }
    groups |= {f"r{d}": [round(rng.uniform(-1, 1) * 10 ** rng.randint(0, 9), d) for _ in range(300)] for d in range(9)}
    df = spark.createDataFrame([(k, v) for k, values in groups.items() for v in values], "k string, v double").repartition(5)
    got = {r.k: (r.v, r.v_count) for r in exact_totals(df, ["k"], {"v": F.col("v")}).collect()}
    for k, values in groups.items():
        known = [v for v in values if v is not None and not math.isnan(v)]
        assert got[k] == (float(sum(Fraction(Decimal(repr(v))) for v in known)), len(known)), k


def test_quantiles_by_rank(spark):
    """A function of the group's size gives the rank; bands of many values are cut."""
    rng = random.Random(6)
    rows = [(k, rng.choice([1.0, -3.0]) + rng.random() / 1000) for k, n in (("a", 700), ("b", 31), ("c", 1)) for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    wanted = {"low": ("v", lambda n: F.floor(n * 0.01)), "third": ("v", lambda n: F.ceil(n / 3)), "half": ("v", 0.5)}
    for split in (10, 100_000):
        for r in quantiles.exact_quantiles(df, ("k",), wanted, split=split).collect():
            own = sorted(v for k, v in rows if k == r.k)
            n = len(own)
            assert (r.low, r.third, r.half) == (own[max(n // 100, 1) - 1], own[math.ceil(n / 3) - 1], own[math.ceil(n / 2) - 1])


def test_infinities_and_no_rows(spark):
    df = spark.createDataFrame([("a", math.inf), ("a", 1.0), ("b", math.inf), ("b", -math.inf), ("c", -math.inf)], "k string, v double")
    got = {r.k: (r.v, r.v_count) for r in exact_totals(df, ["k"], {"v": F.col("v")}).collect()}
    assert got["a"] == (math.inf, 2) and math.isnan(got["b"][0]) and got["c"] == (-math.inf, 1)
    assert {r.k: r[1] for r in df.filter("k <> 'b'").groupBy("k").agg(numbers.exact_avg(F.col("v"))).collect()} == {"a": math.inf, "c": -math.inf}
    assert tuple(exact_totals(df.limit(0), [], {"v": F.col("v")}, {"n": F.lit(1)}).first()) == (None, 0, None)
    assert exact_totals(df.limit(0), ["k"], {"v": F.col("v")}).collect() == []
    one = spark.createDataFrame([(v,) for v in (1.0, math.nan, 3.0)], "v double")
    assert one.agg(numbers.exact_avg(F.col("v"))).first()[0] == 2.0
    assert aggregates.means(one.withColumn("w", F.lit(5)), [], weighted={"m": (F.col("v"), F.col("w"))}, simple={"s": F.col("v")}).first() == (2.0, 2.0)


def test_crime_totals_beyond_an_int(spark):
    df = spark.createDataFrame([(1, 2020, "vol", 3e9, 1.0)], "arrondissement int, annee int, indicateur string, nombre double, taux_pour_mille double")
    assert aggregates.crime_rates(df).first().taux_delinquance_global == 3_000_000_000


def test_a_request_of_odd_digits_is_no_district():
    assert codes.parse_district("²") is None and codes.parse_district("٣") is None and codes.parse_district("75107") == 7


def test_one_year_does_not_overwrite_all(spark):
    with pytest.raises(ConfigurationError):
        jobs.run_gold(spark, "nowhere", "jdbc:none", year=2020)
