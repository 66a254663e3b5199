"""Cleaning and parsing, one test per trap."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import dates, numbers, text


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_trim_strips_blanks_only(spark):
    assert one(spark, text.trim_spaces(F.lit(" \t a  "))) == "\t a "


def test_strip_takes_every_white_space_and_fills_missing(spark):
    assert one(spark, text.strip(F.lit(" \t a b　\n"))) == "a b"
    assert one(spark, text.strip(F.lit(None).cast("string"))) == ""


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" \t  \x1cabé~!", max_size=6), min_size=1, max_size=30))
def test_strip_all_equals_python_strip(spark, values):
    rows = [(i, v, v[::-1]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = {r["i"]: (r["a"], r["b"]) for r in text.strip_all(df).collect()}
    assert got == {i: (a.strip(), b.strip()) for i, a, b in rows}


def test_strip_all_options(spark):
    df = spark.createDataFrame([('"SAN PABLO   "', "NA", 1)], "a string, b string, n int")
    assert text.strip_all(df).first() == ('"SAN PABLO   "', "NA", 1)
    assert text.strip_all(df, na_values=["NA"], drop_quotes=True).first() == ("SAN PABLO", "", 1)


def test_concat_blank_reads_null_as_empty(spark):
    assert one(spark, text.concat_blank(F.lit(5), F.lit("/"), F.lit(None))) == "5/"


def test_case_insensitive_option(spark):
    assert one(spark, text.equal_ignoring_case(F.lit("rioja  "), F.lit("RIOJA")))


def test_byte_length(spark):
    assert one(spark, text.byte_length(F.lit("año"))) == 6
    assert one(spark, text.byte_length(F.lit("año"), unicode_text=False)) == 4


@pytest.mark.parametrize(
    ("written", "value"),
    [("abc", 0), ("", 0), (None, 0), ("-2", 0), ("3.0", 3), ("3.9", 3), (" 7 ", 7), ("NaN", 0)],
)
def test_clamp_count(spark, written, value):
    assert one(spark, numbers.clamp_count(F.lit(written).cast("string"))) == value


def test_negative_sentinel(spark):
    assert one(spark, numbers.drop_negative(F.lit(-1))) is None
    assert one(spark, numbers.drop_negative(F.lit(0))) == 0


@pytest.mark.parametrize(
    ("written", "value"),
    [("S/ 1,225,889.22", "1225889.22"), (" S/ 9.99", "9.99"), ("1,2,3", "123.00"), ("5S/", "5.00")],
)
def test_money(spark, written, value):
    assert one(spark, numbers.parse_money(F.lit(written))) == Decimal(value)


def test_bad_money_fails_or_is_null(spark):
    assert one(spark, numbers.parse_money(F.lit("x"), "null")) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, numbers.parse_money(F.lit("x")))


def test_parse_int_fails_on_text(spark):
    assert one(spark, numbers.parse_int(F.lit(" 5 "))) == 5
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, numbers.parse_int(F.lit("x")))


def test_integer_division(spark):
    assert one(spark, numbers.div(F.lit(7), F.lit(2))) == 3


@pytest.mark.parametrize(
    ("parts", "value"),
    [
        ((2023, 2, 30), None),
        ((2024, 2, 29), date(2024, 2, 29)),
        ((2023, 2, 29), None),
        ((2023, 123, 1), None),
        ((2023, 1, None), None),
        ((2023, 12, 31), date(2023, 12, 31)),
        ((0, 1, 1), None),
        ((2023, 1, 0), None),
    ],
)
def test_date_policies(spark, parts, value):
    cols = [F.lit(p).cast("int") for p in parts]
    assert one(spark, dates.date_from_parts(*cols)) == value
    if value is None and None not in parts and parts[0]:
        with pytest.raises(Exception, match="DATETIME_FIELD_OUT_OF_BOUNDS"):
            one(spark, dates.date_from_parts(*cols, on_bad_date="fail"))


def test_padded_date_guards_missing_day(spark):
    day = F.lit(None).cast("int")
    assert one(spark, dates.date_from_padded(F.lit(2023), F.lit(1), day)) is None
    assert one(spark, dates.date_from_padded(F.lit(2023), F.lit(1), F.lit(5))) == date(2023, 1, 5)


def test_text_dates_and_wire_format(spark):
    assert one(spark, dates.parse_compact(F.lit("20231220"))) == date(2023, 12, 20)
    assert one(spark, dates.parse_day_first(F.lit("31/12/2025"))) == date(2025, 12, 31)
    assert one(spark, dates.parse_day_first(F.lit("12/31/2025"), "null")) is None
    assert one(spark, dates.utc_midnight(F.lit("2023-01-02").cast("date"))) == "2023-01-02T00:00:00Z"
    assert one(spark, dates.utc_midnight(F.lit(None).cast("date"))) is None


def test_month_name(spark):
    assert one(spark, dates.month_name(F.lit(9))) == "Septiembre"
    assert one(spark, dates.month_name(F.lit(13))) is None
