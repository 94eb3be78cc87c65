from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eodlake.functions import calendar


def dates(df):
    return sorted(r.date for r in df.collect())


def test_weekdays_and_trading_days(spark):
    january = calendar.days_between(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert january.count() == 31
    assert calendar.weekdays(january).count() == 23
    trading = dates(calendar.trading_days(january))
    assert len(trading) == 21
    assert dt.date(2024, 1, 22) not in trading and dt.date(2024, 1, 26) not in trading


def test_unknown_year_has_no_holidays(spark):
    day = spark.createDataFrame([(dt.date(2030, 1, 26),)], "date date")
    assert day.select(calendar.is_holiday(F.col("date"))).first()[0] is False


def test_reversed_range(spark):
    with pytest.raises(ValueError, match="on or after"):
        calendar.days_between(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1))
    bounds = spark.createDataFrame([(dt.date(2024, 1, 2), dt.date(2024, 1, 1))], "start date, end date")
    assert calendar.date_range(bounds).count() == 0


def test_holidays_per_year(spark):
    assert calendar.holidays(spark, [2024]).count() == 14
    assert calendar.holidays(spark, [1999]).count() == 0


def test_month_bounds():
    assert calendar.month_bounds("2024-02") == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert calendar.month_bounds("2023-12") == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))
