"""Trading calendar as small DataFrames, sized by days and never by the data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.model import HOLIDAYS


def holiday_dates() -> list[dt.date]:
    return [dt.date.fromisoformat(day) for day in HOLIDAYS]


def holidays(spark: SparkSession, years: list[int] | None = None) -> DataFrame:
    """(year, date) of the advisory holidays; years outside the table have none."""
    days = [(d.year, d) for d in holiday_dates() if years is None or d.year in years]
    return spark.createDataFrame(days, "year int, date date")


def is_holiday(day: Column) -> Column:
    """Membership in the fixed holiday list (some fifty literals, no join needed)."""
    return F.coalesce(day.isin(holiday_dates()), F.lit(False))


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def is_trading_day(day: Column) -> Column:
    return is_weekday(day) & ~is_holiday(day)


def date_range(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day of each closed [start, end] range; a reversed range has no days."""
    return bounds.where(F.col(start) <= F.col(end)).withColumn(
        "date", F.explode(F.sequence(F.col(start), F.col(end)))
    )


def days_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar days of [start, end]; raises on a reversed range."""
    if end < start:
        raise ValueError(f"end ({end}) must be on or after start ({start})")
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return date_range(bounds).select("date")


def weekdays(days: DataFrame) -> DataFrame:
    return days.where(is_weekday(F.col("date")))


def trading_days(days: DataFrame) -> DataFrame:
    """Weekdays that are no advisory holiday."""
    return days.where(is_trading_day(F.col("date")))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def month_bounds(month: str) -> tuple[dt.date, dt.date]:
    """First and last day of a 'YYYY-MM' month."""
    first = dt.date.fromisoformat(f"{month}-01")
    following = (first + dt.timedelta(days=31)).replace(day=1)
    return first, following - dt.timedelta(days=1)
