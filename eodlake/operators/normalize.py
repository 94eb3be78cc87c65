"""Raw text frame -> typed frame, one projection per product.

The typed frame keeps every row, with `file_date` (the day the file claims), `row_no` (its order in
the file) and `date_text` (the date as written); the cleaners in `clean.py` check and filter it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.functions.text import blank_to, identifier, strip, to_date, to_double, to_long
from eodlake.model import LISTING_DATE_PATTERNS
from eodlake.operators.layout import Layout, match_headers

META = ("file_date", "row_no")


def with_file_columns(raw: DataFrame, expected_day: dt.date | None = None) -> DataFrame:
    """Add `file_date` and `row_no` to a bare one-file frame."""
    if "file_date" not in raw.columns:
        raw = raw.withColumn("file_date", F.lit(expected_day).cast("date"))
    if "row_no" not in raw.columns:
        raw = raw.withColumn("row_no", F.monotonically_increasing_id())
    return raw


def _zero_if_bad(layout: Layout, *columns: str) -> list[Column]:
    """Quantities: bad, empty and absent all become 0."""
    return [F.coalesce(to_long(layout.text(c)), F.lit(0)).alias(c) for c in columns]


def _null_if_bad(layout: Layout, *columns: str) -> list[Column]:
    """Prices: bad, empty and absent all become null."""
    return [to_double(layout.text(c)).alias(c) for c in columns]


def _typed(raw: DataFrame, layout: Layout, *columns: Column) -> DataFrame:
    if raw.isStreaming:
        raise ValueError("clean a stream inside foreachBatch")
    return raw.select(*META, layout.text("date").alias("date_text"), *columns)


def type_bars(raw: DataFrame, layout: Layout) -> DataFrame:
    text = layout.text
    return _typed(
        raw,
        layout,
        identifier(text("symbol")).alias("symbol"),
        identifier(text("series")).alias("series"),
        to_date(strip(text("date")), layout.product.date_pattern).alias("date"),
        *_null_if_bad(layout, "prev_close", "open", "high", "low", "last", "close", "avg_price"),
        *_zero_if_bad(layout, "total_traded_quantity"),
        layout.scale("turnover", to_double(text("turnover"))).alias("turnover"),
        *_zero_if_bad(layout, "no_of_trades", "delivery_qty"),
        # an absent ratio is 0, an unreadable one is null
        (to_double(text("delivery_pct")) if layout.has("delivery_pct") else F.lit(0.0)).alias(
            "delivery_pct"
        ),
    )


def type_index(raw: DataFrame, layout: Layout) -> DataFrame:
    text = layout.text
    return _typed(
        raw,
        layout,
        identifier(text("index_name")).alias("index_name"),
        to_date(strip(text("date")), layout.product.date_pattern).alias("date"),
        *_null_if_bad(layout, "open", "high", "low", "close"),
        *_zero_if_bad(layout, "volume"),
        F.coalesce(to_double(text("turnover")), F.lit(0.0)).alias("turnover"),
    )


def type_fo(raw: DataFrame, layout: Layout) -> DataFrame:
    text = layout.text
    value = F.coalesce(to_double(text("value")), F.lit(0.0))
    return _typed(
        raw,
        layout,
        identifier(text("instrument")).alias("instrument"),
        identifier(text("symbol")).alias("symbol"),
        to_date(strip(text("expiry_date")), layout.product.date_pattern).alias("expiry_date"),
        blank_to(text("option_type"), "XX").alias("option_type"),
        F.coalesce(to_double(text("strike_price")), F.lit(0.0)).alias("strike_price"),
        to_date(strip(text("date")), layout.product.date_pattern).alias("date"),
        *_null_if_bad(layout, "open", "high", "low", "close", "settle_price"),
        *_zero_if_bad(layout, "contracts"),
        layout.scale("value", value).alias("value"),
        *_zero_if_bad(layout, "open_interest", "change_in_oi"),
    )


def type_deliverable(raw: DataFrame, layout: Layout) -> DataFrame:
    text = layout.text
    return _typed(
        raw,
        layout,
        identifier(text("symbol")).alias("symbol"),
        blank_to(text("series"), "EQ").alias("series"),
        to_date(strip(text("date")), layout.product.date_pattern).alias("date"),
        *_zero_if_bad(layout, "quantity_traded", "delivery_quantity"),
        *_null_if_bad(layout, "delivery_to_traded"),
    )


def type_master(raw: DataFrame, layout: Layout) -> DataFrame:
    text = layout.text
    return raw.select(
        "row_no",
        identifier(text("symbol")).alias("symbol"),
        strip(text("name")).alias("name"),
        identifier(text("series")).alias("series"),
        identifier(text("isin")).alias("isin"),
        to_date(text("listing_date"), *LISTING_DATE_PATTERNS).alias("listing_date"),
    )


_TYPERS = {
    "cm": type_bars,
    "idx": type_index,
    "fo": type_fo,
    "deliv": type_deliverable,
    "master": type_master,
}


def typed(raw: DataFrame, product: str, expected_day: dt.date | None = None) -> DataFrame:
    """Typed frame of one layout; raises ValueError if a required column is missing."""
    layout = match_headers(product, raw.columns)
    if product == "fo" and not layout.has("date"):
        if expected_day is None and "file_date" not in raw.columns:
            raise ValueError("the file has no TIMESTAMP column and no file day is given")
    return _TYPERS[product](with_file_columns(raw, expected_day), layout)
