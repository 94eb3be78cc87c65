from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eodlake.functions import text


def value(spark, fn, s):
    return spark.createDataFrame([(s,)], "s string").select(fn(F.col("s"))).first()[0]


@pytest.mark.parametrize(
    ("s", "expected"),
    [("12", 12), (" -7\t", -7), ("+5", 5), ("1.0", None), ("1e3", None), ("-", None), ("", None),
     (None, None), ("1,000", None), ("99999999999999999999", None)],
)
def test_to_long(spark, s, expected):
    assert value(spark, text.to_long, s) == expected


@pytest.mark.parametrize(
    ("s", "expected"),
    [("12.5", 12.5), (" .5", 0.5), ("-.69", -0.69), ("5.", 5.0), ("1e3", 1000.0), ("+2", 2.0),
     ("1d", None), ("1.5f", None), ("0x1p3", None), ("NaN", None), ("inf", None), ("Infinity", None),
     ("-", None), ("", None), (None, None), ("1,5", None)],
)
def test_to_double(spark, s, expected):
    assert value(spark, text.to_double, s) == expected


def test_strip_takes_all_white_space(spark):
    assert value(spark, text.strip, "\t  a b \r\n ") == "a b"


@pytest.mark.parametrize(
    ("s", "expected"),
    [("03-JAN-2024", dt.date(2024, 1, 3)), ("3-Jan-2024", dt.date(2024, 1, 3)),
     ("03-jan-2024", dt.date(2024, 1, 3)), ("31-FEB-2024", None), ("2024-01-03", None), (None, None)],
)
def test_trade_date(spark, s, expected):
    assert value(spark, lambda c: text.to_date(c, "d-MMM-yyyy"), s) == expected


def test_blank_to(spark):
    fn = lambda c: text.blank_to(c, "XX")
    assert [value(spark, fn, s) for s in (None, "", "  ", " pe ")] == ["XX", "XX", "XX", "PE"]


@pytest.mark.parametrize(
    ("x", "expected"), [(1.005, 1.0), (2.675, 2.68), (-1.5, -1.5), (0.125, 0.13), (None, None)]
)
def test_round_to(spark, x, expected):
    got = spark.createDataFrame([(x,)], "x double").select(text.round_to(F.col("x"), 2)).first()[0]
    assert got == expected
