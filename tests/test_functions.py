"""Column expressions on hand-written edge values."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from terrazzo.functions import air, classes, codes, numbers, parsing
from terrazzo.operators.filters import contains_any, has_prefix
from terrazzo.session import staged


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], f"v {schema}").select(column).collect()]


def test_decimal_text(spark):
    got = values(spark, parsing.decimal_text("v"), ["12,5", "12.5", " 7 ", "", "x", "1,2,3", None], "string")
    assert got == [12.5, 12.5, 7.0, None, None, None, None]


def test_whole_and_truncated(spark):
    assert values(spark, parsing.whole("v"), ["3", "x", "", None, "99999999999"], "string") == [3, None, None, None, None]
    assert values(spark, parsing.truncated("v"), ["3.9", "-3.9", "x", "4"], "string") == [3, -3, None, 4]


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("01/02/2024",), (None,)], "v string")
    got = [r[0] for r in df.select(parsing.iso_date(df, "v")).collect()]
    assert got == [dt.date(2024, 2, 29), None, None, None]


def test_number_or_null(spark):
    assert values(spark, parsing.number_or_null("v"), ["1.5", "NaN", "x", None], "string") == [1.5, None, None, None]


@pytest.mark.parametrize(
    "code, district",
    [("75100", None), ("75101", 1), ("75109", 9), ("75110", 10), ("75120", 20), ("75121", None), ("7510", None), (None, None)],
)
def test_area_codes(spark, code, district):
    df = spark.createDataFrame([(code,)], "v string").filter(codes.is_area_code("v")).select(codes.district_of_code("v"))
    assert [r[0] for r in df.collect()] == ([] if district is None else [district])


def test_codes_round_trip(spark):
    df = spark.range(1, 21).select(codes.code_of_district("id").alias("c"), "id")
    assert df.filter(codes.district_of_code("c") != F.col("id")).count() == 0
    assert [r[0] for r in df.orderBy("id").select("c").collect()] == codes.area_codes()


REQUESTS = {"75101": 1, "75120": 20, "75121": None, "75100": None, "1": 1, "20": 20, "0": None, "21": None, "all": None, "": None, "x": None, " 7 ": 7}


def test_requests_in_both_forms(spark):
    assert values(spark, codes.district_of_request("v"), list(REQUESTS), "string") == list(REQUESTS.values())
    assert [codes.parse_district(r) for r in REQUESTS] == list(REQUESTS.values())
    assert codes.parse_district(None) is None and codes.parse_district(7) == 7


def test_zone(spark):
    assert values(spark, codes.district_of_zone("v"), ["751072605", "751200101", "75", None], "string") == [7, 20, None, None]


def test_ratio_and_change(spark):
    df = spark.createDataFrame([(10.0, 4.0), (1.0, 0.0), (1.0, None), (1.005, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"), 2)).collect()] == [2.5, None, None, 1.01]
    df = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0), (1.0, -5.0), (1.0, None), (None, 5.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.percent_change(F.col("a"), F.col("b"))).collect()] == [10.0, None, None, None, None]


def test_exact_sums_do_not_depend_on_order(spark):
    rows = [(0.1,)] * 10 + [(1e9,), (-1e9,), (0.05,)]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "v double").repartition(parts)
        assert df.agg(numbers.exact_sum(F.col("v"))).first()[0] == 1.05
    empty = spark.createDataFrame([(None,)], "v double")
    assert empty.agg(numbers.exact_sum(F.col("v")), numbers.exact_avg(F.col("v"))).first() == (None, None)


def test_room_class(spark):
    got = values(spark, classes.room_class(F.col("v")), [None, "x", "0", "1", "2", "3", "4", "5", "9"], "string")
    assert got == ["studio_t1"] * 4 + ["t2", "t3", "t4", "t5_plus", "t5_plus"]


def test_zero_and_missing_rooms_are_in_no_gold_class(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (5,)], "v int")
    flags = classes.room_flags(F.col("v"))
    row = df.agg(*[numbers.share_of(f).alias(n) for n, f in flags.items()]).first()
    assert row.asDict() == {"part_studio_t1": 25.0, "part_t2": 0.0, "part_t3": 0.0, "part_t4": 0.0, "part_t5_plus": 25.0}


def test_surface_class(spark):
    got = values(spark, classes.surface_class(F.col("v")), [None, "x", "NaN", "19.99", "20", "40", "60", "80", "119.9", "120"], "string")
    assert got == [None, None, None, "lt_20", "bt_20_40", "bt_40_60", "bt_60_80", "bt_80_120", "bt_80_120", "gt_120"]


def test_price_step(spark):
    assert values(spark, classes.price_step(F.col("v")), [8999.99, 9000.0, 11000.0, 13000.0, None], "double") == [0, 1, 2, 3, None]


def test_air_severity_and_worst(spark):
    df = spark.createDataFrame([("Bon", "Mauvais", "Mauvais"), ("?", None, "Moyen"), (None, None, None)], "a string, b string, c string")
    worst = air.worst_pollutants({n: F.col(n) for n in "abc"})
    assert [r[0] for r in df.select(worst).collect()] == ["b,c", "c", None]


DOCUMENTS = [
    ({"data": [{"label": "Bon", "indice": "x"}]}, "Bon"),
    ({"data": [{"qualif": "Moyen"}]}, "Moyen"),
    ({"data": [{"label": "", "indice": "Mauvais"}]}, "Mauvais"),
    ({"data": {"75101": [{"date": "d", "indice": "Bon"}, {"indice": "x"}]}}, "Bon"),
    ({"data": [], "today": "Moyen"}, "Moyen"),
    ({"label": {"qualif": "Bon"}}, "Bon"),
    ({"indice": {"label": "Bon", "qualif": "x"}}, "Bon"),
    ({"label": 3, "qualif": "Bon"}, "Bon"),
    ({"insee": "75101"}, None),
    ({}, None),
]


def test_document_label(spark):
    rows = [json.dumps(d) for d, _ in DOCUMENTS] + ["{broken", None]
    assert values(spark, air.document_label(F.col("v")), rows, "string") == [w for _, w in DOCUMENTS] + [None, None]


def test_stored_documents_are_not_parsed_again(spark):
    rows = [(i, json.dumps(d)) for i, (d, _) in enumerate(DOCUMENTS)] + [(97, "{broken"), (98, None), (99, "null")]
    table = spark.createDataFrame(rows, "n int, text string").select("n", F.try_parse_json("text").alias("document"))
    labels = staged(table, "documents").select("n", air.variant_label(F.col("document")).alias("label"))
    assert "parse_json" not in labels._jdf.queryExecution().executedPlan().toString()
    assert [r.label for r in labels.orderBy("n").collect()] == [w for _, w in DOCUMENTS] + [None] * 3


def test_text_tests(spark):
    rows = ["vols et coups", "Violences", None, "75101"]
    assert values(spark, contains_any(F.col("v"), ["violence", "coups"]), rows, "string") == [True, False, None, False]
    assert values(spark, contains_any(F.col("v"), ["violence"], ignore_case=True), rows, "string") == [False, True, None, False]
    assert values(spark, has_prefix(F.col("v"), "75"), rows, "string") == [False, False, False, True]
