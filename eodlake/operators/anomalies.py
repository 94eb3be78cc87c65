"""Price, volume and delivery anomalies over the stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXTREME_MOVE_LIMIT = 0.25
SAMPLES_PER_CODE = 5
CODES = (
    "EXTREME_MOVE", "ZERO_VOLUME_WITH_TRADES", "NEGATIVE_PRICE", "DELIVERY_MISMATCH",
)


def within(df: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end))
    return df


def is_extreme_move() -> Column:
    move = F.abs(F.try_divide(F.col("close"), F.col("prev_close")) - 1)
    return (F.col("series") == "EQ") & (F.col("prev_close") > 0) & (move > EXTREME_MOVE_LIMIT)


def is_zero_volume() -> Column:
    return (F.col("total_traded_quantity") <= 0) & (F.col("no_of_trades") > 0)


def is_negative_price() -> Column:
    return (
        (F.col("close") < 0) | (F.col("high") < 0) | (F.col("open") < 0) | (F.col("low") < 0)
    )


def extreme_moves(bars: DataFrame, start=None, end=None) -> DataFrame:
    return within(bars, start, end).where(is_extreme_move()).select(
        "symbol", "date", "prev_close", "close"
    )


def zero_volumes(bars: DataFrame, start=None, end=None) -> DataFrame:
    return within(bars, start, end).where(is_zero_volume()).select(
        "symbol", "date", "total_traded_quantity", "no_of_trades"
    )


def negative_prices(bars: DataFrame, start=None, end=None) -> DataFrame:
    return within(bars, start, end).where(is_negative_price()).select(
        "symbol", "date", "open", "high", "low", "close"
    )


def delivery_mismatches(
    bars: DataFrame, deliveries: DataFrame, start=None, end=None
) -> DataFrame:
    """Bars whose delivered quantity differs from the EQ deliverable row of symbol and day.

    Both sides are filtered before the join; at most one delivery and a handful of series share a
    join key, so no key can be hot.
    """
    traded = within(bars, start, end).where(F.col("delivery_qty") > 0).select(
        "symbol", "date", "series", "delivery_qty"
    )
    delivered = within(deliveries, start, end).where(F.col("series") == "EQ").select(
        "symbol", "date", "delivery_quantity"
    )
    return (
        traded.join(delivered, ["symbol", "date"])
        .where(F.col("delivery_qty") != F.col("delivery_quantity"))
        .select("symbol", "date", "delivery_qty", "delivery_quantity", "series")
    )


def _sample(*columns: str) -> Column:
    """Named values as text, in column order."""
    return F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("value"),
            )
            for c in ("symbol", "date", *columns)
        ]
    )


def anomalies(tables: Mapping[str, DataFrame], start=None, end=None) -> DataFrame:
    """All anomaly rows as (code, date, symbol, series, sample): one scan of the bars for the
    three single-row rules, one join for the deliveries."""
    bars = within(tables["bhav_daily"], start, end)
    rules = [
        ("EXTREME_MOVE", is_extreme_move(), ("prev_close", "close")),
        ("ZERO_VOLUME_WITH_TRADES", is_zero_volume(), ("total_traded_quantity", "no_of_trades")),
        ("NEGATIVE_PRICE", is_negative_price(), ("open", "high", "low", "close")),
    ]
    hits = F.array(
        *[
            F.when(hit, F.struct(F.lit(code).alias("code"), _sample(*columns).alias("sample")))
            for code, hit, columns in rules
        ]
    )
    single = (
        bars.where(is_extreme_move() | is_zero_volume() | is_negative_price())
        .select("date", "symbol", "series", F.explode(F.array_compact(hits)).alias("hit"))
        .select("hit.code", "date", "symbol", "series", "hit.sample")
    )
    mismatches = delivery_mismatches(
        tables["bhav_daily"], tables["deliverable_daily"], start, end
    ).select(
        F.lit("DELIVERY_MISMATCH").alias("code"), "date", "symbol", "series",
        _sample("delivery_qty", "delivery_quantity").alias("sample"),
    )
    return single.unionByName(mismatches)


def codes(df: DataFrame) -> DataFrame:
    """The fixed list of codes with their report order."""
    rows = [(i, c) for i, c in enumerate(CODES, 1)]
    return df.sparkSession.createDataFrame(rows, "code_no int, code string")


def anomaly_counts(found: DataFrame) -> DataFrame:
    """(code_no, code, count) with 0 for codes that do not occur."""
    counts = found.groupBy("code").agg(F.count(F.lit(1)).alias("count"))
    return codes(found).join(counts, "code", "left").select(
        "code_no", "code", F.coalesce("count", F.lit(0)).alias("count")
    )


def anomaly_samples(found: DataFrame, per_code: int = SAMPLES_PER_CODE) -> DataFrame:
    """First rows of each code by date and symbol.

    Spark cuts each task to `per_code` rows per code before the shuffle (window group limit), so a
    frequent code does not pile up in one task.
    """
    order = Window.partitionBy("code").orderBy("date", "symbol", "series")
    return (
        found.withColumn("ord", F.row_number().over(order))
        .where(F.col("ord") <= per_code)
        .select("code", "ord", "sample")
    )


def master_drift(bars: DataFrame, master: DataFrame) -> DataFrame:
    """EQ symbols that have bars but no master row; none while the master is empty."""
    return (
        bars.where(F.col("series") == "EQ")
        .select("symbol")
        .distinct()
        .join(master.select("symbol"), "symbol", "left_anti")
        .where(master.exists())
    )
