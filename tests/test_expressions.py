"""Column expressions on values written by hand."""

import pytest
from pyspark.sql import functions as F

from skyledger.functions import measures as m, numbers as n, text as t

c = F.col


def values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(expr).collect()]


def test_strip_knows_every_kind_of_space(spark):
    rows = [(" \tAA\n",), ("  AA　",), (None,), ("   ",)]
    assert values(spark, rows, "x string", t.strip(c("x"))) == ["AA", "AA", None, ""]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("American Airlines Inc.", "AMERICAN AIRLINES"),
        ("AMERICAN AIRLINES, INC.", "AMERICAN AIRLINES"),
        (" Amer. Airlines Inc. ", "AMERICAN AIRLINES"),
        ("AmericanAirlines", "AMERICAN AIRLINES"),
        ("Southwest Air Co.", "SOUTHWEST AIRLINES"),
        ("Delta  Airls   Intl", "DELTA AIR LINES INTERNATIONAL"),
        ("AIRLS AIRLS. AMER", "AIR LINES AIR LINES AMERICAN"),
        ("AEROMEXICO", "AEROMEXI"),  # the suffix has no word boundary
        ("X CO. INC.", "X CO."),  # one suffix per pass
        ("Caribbean Airlines Limited", "CARIBBEAN AIRLINES"),
        ("AMERX AMER-X", "AMERX AMER-X"),
        ("", ""),
        (None, None),
    ],
)
def test_normalize_name(spark, raw, expected):
    assert values(spark, [(raw,)], "x string", t.normalize_name(c("x"))) == [expected]


def test_code_suffix(spark):
    rows = [("AA(1)",), ("AA (12)",), ("A(1)A",), (None,)]
    assert values(spark, rows, "x string", t.strip_code_suffix(c("x"))) == ["AA", "AA", "A(1)A", None]
    assert values(spark, rows[1:2], "x string", t.strip_code_suffix(c("x"), False)) == ["AA "]


def test_blank_and_tokens(spark):
    rows = [("",), (" \t",), ("x",), (None,), ("NA",)]
    assert values(spark, rows, "x string", t.blank_to_null(c("x"))) == [None, None, "x", None, "NA"]
    assert values(spark, rows, "x string", t.tokens_to_null(c("x"))) == [None, " \t", "x", None, None]


def test_city(spark):
    rows = [("Atlanta, GA: Hartsfield: Intl",), ("Nowhere",), (None,)]
    assert values(spark, rows, "x string", t.city_of(c("x"))) == ["Atlanta, GA", "Nowhere", None]


def test_numbers_from_text(spark):
    rows = [("12.0",), ("x",), ("",), (None,), (" 7 ",), ("NaN",), ("1e3",), ("99999999999",)]
    assert values(spark, rows, "x string", n.to_number(c("x"), "int")) == [
        12, None, None, None, 7, None, 1000, None
    ]
    assert values(spark, [("2024-02-30",), ("2024-02-29",), ("soon",)], "x string",
                  n.to_date(c("x")).cast("string")) == [None, "2024-02-29", None]


def test_caps_need_both_sides(spark):
    rows = [(5, 3), (2, 3), (None, 3), (5, None)]
    assert values(spark, rows, "a int, b int", n.cap(c("a"), c("b"))) == [3, 2, None, 5]


def test_ratio_rounds_half_to_even_and_guards_zero(spark):
    rows = [(1, 32), (3, 32), (1, 0), (None, 5), (1, None), (1, -2), (2, 3)]
    assert values(spark, rows, "a int, b int", n.ratio(c("a"), c("b"))) == [
        0.0312, 0.0938, 0.0, 0.0, 0.0, 0.0, 0.6667
    ]


def test_season_and_delay(spark):
    rows = [(12,), (2,), (3,), (8,), (9,), (13,), (None,)]
    assert values(spark, rows, "x int", m.season(c("x"))) == [1, 1, 2, 3, 4, 0, 0]
    assert values(spark, [(1,), (4,), (0,)], "x int", m.season_label(c("x"))) == ["Invierno", "Otoño", None]
    assert values(spark, [(90, 60), (None, 60)], "r int, a int", m.runway_delay(c("r"), c("a"))) == [30, 0]
