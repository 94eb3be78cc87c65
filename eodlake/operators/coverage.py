"""What the ingest log covers, against the calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.functions.calendar import days_between, is_holiday, is_trading_day, is_weekday
from eodlake.model import ERROR, INGESTED, NON_TRADING, SKIPPED

SIDE_TABLES = ("index_daily", "fo_daily", "deliverable_daily")
GAP_DETAIL = {
    "missing_attempt": "no ingest record",
    "ingest_error": "ingest failed",
    "unknown_holiday": "server reported non-trading day",
}


def _status_counts() -> list[Column]:
    status = F.col("status")
    return [
        F.count_if(status.isin(INGESTED, SKIPPED)).alias("data_days"),
        F.count_if(status == NON_TRADING).alias("holidays"),
        F.count_if(status == ERROR).alias("errors"),
    ]


def log_range(log: DataFrame) -> DataFrame:
    """First and last logged day per product."""
    return (
        log.where(F.col("status").isin(INGESTED, SKIPPED, ERROR, NON_TRADING))
        .groupBy("product")
        .agg(F.min("date").alias("first"), F.max("date").alias("last"))
    )


def status_by_month(log: DataFrame, newest: int = 24) -> DataFrame:
    """Day counts per product and month, newest months first."""
    return (
        log.groupBy("product", F.date_format("date", "yyyy-MM").alias("month"))
        .agg(*_status_counts())
        .orderBy(F.desc("month"), F.asc("product"))
        .limit(newest)
    )


def _per_product(days: DataFrame, products: list[str]) -> DataFrame:
    """Calendar rows once per product."""
    return days.withColumn("product", F.explode(F.array(*[F.lit(p) for p in products])))


def month_coverage(
    log: DataFrame, products: list[str], start: dt.date, end: dt.date
) -> DataFrame:
    """Expected and logged days per product and month of the range, in one pass over the log."""
    month = F.date_format("date", "yyyy-MM").alias("month")
    expected = (
        days_between(log.sparkSession, start, end)
        .groupBy(month)
        .agg(F.count_if(is_trading_day(F.col("date"))).alias("expected"))
    )
    logged = (
        log.where(F.col("date").between(F.lit(start), F.lit(end)))
        .groupBy("product", month)
        .agg(*_status_counts())
    )
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("data_days", "holidays", "errors")]
    # data on an advisory holiday counts as data, so the figure can exceed 100
    pct = F.round(F.try_divide(100 * F.col("data_days"), F.col("expected")), 2)
    return (
        _per_product(expected, products)
        .join(logged, ["product", "month"], "left")
        .select("product", "month", "expected", *filled)
        .withColumn("coverage_pct", F.when(F.col("expected") > 0, pct).otherwise(100.0))
    )


def gap_type() -> Column:
    """Kind of gap of a weekday with log `status` (null: no row), null if it is none."""
    day, status = F.col("date"), F.col("status")
    return (
        F.when(status.isNull() & ~is_holiday(day), "missing_attempt")
        .when(status == ERROR, "ingest_error")
        .when((status == NON_TRADING) & ~is_holiday(day), "unknown_holiday")
    )


def detect_gaps(
    log: DataFrame, products: list[str], start: dt.date, end: dt.date
) -> DataFrame:
    """(product, date, gap_type): weekdays of the range against the log."""
    days = days_between(log.sparkSession, start, end).where(is_weekday(F.col("date")))
    logged = log.where(F.col("date").between(F.lit(start), F.lit(end))).select(
        "product", "date", "status"
    )
    return (
        _per_product(days, products)
        .join(logged, ["product", "date"], "left")
        .select("product", "date", gap_type().alias("gap_type"))
        .where(F.col("gap_type").isNotNull())
    )


def gap_rows(
    gaps: DataFrame, drift: DataFrame, products: list[str], end: dt.date
) -> DataFrame:
    """Rows of the gap table: one per gap, and one per product that sums up the master drift."""
    detail = F.create_map(*[F.lit(x) for pair in GAP_DETAIL.items() for x in pair])
    days = gaps.select("product", "date", "gap_type", detail[F.col("gap_type")].alias("detail"))
    # the first five only: the list itself may be long
    preview = drift.orderBy("symbol").limit(5).agg(
        F.array_join(F.sort_array(F.collect_list("symbol")), ", ")
    )
    summary = drift.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(
        F.lit(end).alias("date"),
        F.lit("symbol_not_in_master").alias("gap_type"),
        F.concat(
            F.col("n").cast("string"),
            F.lit(" EQ symbols with bars missing from master (e.g. "),
            preview.scalar(),
            F.lit(")"),
        ).alias("detail"),
    )
    return days.unionByName(_per_product(summary, products))


def cross_tables(tables: Mapping[str, DataFrame], start: dt.date, end: dt.date) -> DataFrame:
    """Days, rows, first and last date of the side tables within the range.

    Grouping by day first keeps the distinct count to one row per day in the shuffle.
    """
    out = None
    for name in SIDE_TABLES:
        per_day = (
            tables[name].where(F.col("date").between(F.lit(start), F.lit(end)))
            .groupBy("date").agg(F.count(F.lit(1)).alias("n"))
        )
        one = per_day.agg(
            F.count(F.lit(1)).alias("days"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.min("date").alias("first"),
            F.max("date").alias("last"),
        ).select(F.lit(name).alias("table"), "days", "rows", "first", "last")
        out = one if out is None else out.unionByName(one)
    return out
