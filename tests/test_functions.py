"""Column functions: typing, money, labels, part of day, distance."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from blotter.functions import (
    descent_label,
    haversine_km,
    money_to_int,
    part_of_day,
    us_date_text,
)
from blotter.functions.typed import as_date, as_float, as_int


def one_col(spark, values, type_name, expr):
    df = spark.createDataFrame([(v,) for v in values], f"v {type_name}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("out")).collect()]


def test_us_date_text_forms(spark):
    values = [
        "01/08/2020 12:00:00 AM",
        "1/8/2020",
        "12/31/2019 11:59:00 PM",
        "  03/04/2021 00:00",
        "junk",
        "",
        None,
        "13/40/2020 01:00:00 PM",
        "2020-01-08",
        "2020-01-08 13:45:00",
        "2020-13-08",
    ]
    got = one_col(spark, values, "string", us_date_text)
    assert got == [
        dt.date(2020, 1, 8),
        dt.date(2020, 1, 8),
        dt.date(2019, 12, 31),
        dt.date(2021, 3, 4),
        None,
        None,
        None,
        None,
        dt.date(2020, 1, 8),
        dt.date(2020, 1, 8),
        None,
    ]


def test_as_date_passes_typed_columns(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2015, 5, 6, 23, 59), dt.date(2015, 5, 6), "05/06/2015 11:00:00 PM")],
        "ts timestamp_ntz, d date, s string",
    )
    out = df.select(as_date(df, "ts"), as_date(df, "d"), as_date(df, "s")).collect()[0]
    assert tuple(out) == (dt.date(2015, 5, 6),) * 3


def test_numeric_typing_never_raises(spark):
    df = spark.createDataFrame([(" 42 ",), ("x",), ("",), (None,), ("1.5",)], "v string")
    got = [tuple(r) for r in df.select(as_int(df, "v"), as_float(df, "v")).collect()]
    assert got == [(42, 42.0), (None, None), (None, None), (None, None), (None, 1.5)]


def test_money_to_int(spark):
    values = ["$12,345", "12345", "$1,000,000", " $7 ", "$12,34a", "$", None, "$-1,234"]
    assert one_col(spark, values, "string", money_to_int) == [12345, 12345, 1000000, 7, None, None, None, -1234]


def test_descent_label_fixed_codes_and_errors(spark):
    values = ["W", "B", "H", "C", "O", "A", "X", "K", "Z", None, "w"]
    got = one_col(spark, values, "string", descent_label)
    assert got == [
        "White",
        "Black",
        "Hispanic",
        "Chinese",
        "Other",
        "Other Asian",
        "Unknown",
        "Error",
        "Error",
        "Error",
        "Error",
    ]


@pytest.mark.parametrize(
    "hhmm,label",
    [
        (0, "night"),
        (459, "night"),
        (500, "morning"),
        (1159, "morning"),
        (1200, "afternoon"),
        (1659, "afternoon"),
        (1700, "evening"),
        (2059, "evening"),
        (2100, "night"),
        (2359, "night"),
        (None, None),
    ],
)
def test_part_of_day_boundaries(spark, hhmm, label):
    assert one_col(spark, [hhmm], "int", part_of_day) == [label]


def _py_haversine(lat1, lon1, lat2, lon2, r=6373.0):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dphi, dlam = p2 - p1, math.radians(lon2) - math.radians(lon1)
    a = math.sin(dphi / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dlam / 2) ** 2
    return r * (2 * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0))))


def test_haversine_known_pairs(spark):
    pairs = [
        (34.0522, -118.2437, 34.0522, -118.2437),  # same point
        (34.0522, -118.2437, 33.9416, -118.4085),  # downtown to the airport
        (0.0, 0.0, 0.0, 180.0),  # antipodes on the equator
        (90.0, 0.0, -90.0, 0.0),  # pole to pole
        (10.0, 20.0, -30.0, 40.0),
    ]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    back = [r[0] for r in df.select(haversine_km(F.col("c"), F.col("d"), F.col("a"), F.col("b"))).collect()]
    for (p, g, bk) in zip(pairs, got, back):
        assert g == pytest.approx(_py_haversine(*p), rel=1e-12, abs=1e-9)
        assert g == pytest.approx(bk, rel=1e-12, abs=1e-9)  # symmetric
    assert got[0] == 0.0
    assert got[2] == pytest.approx(math.pi * 6373.0)
    assert 10 < got[1] < 25


def test_haversine_null_coordinates_stay_null(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0), (1.0, None, 2.0, 3.0), (1.0, 1.0, None, None)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert got == [None, None, None]


def test_whole_numbers_with_a_decimal_part(spark):
    from blotter.functions.typed import as_int

    df = spark.createDataFrame([("101",), ("101.0",), (" 101.00 ",), ("101.5",), ("abc",), ("",), ("1e2",), ("9e12",)], "x string")
    assert [r[0] for r in df.select(as_int(df, "x")).collect()] == [101, 101, 101, None, None, None, 100, None]
