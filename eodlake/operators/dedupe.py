"""One row per key.

Both forms thin out each task's rows before the shuffle, so a key that holds a large share of all rows
reaches it as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, key: Sequence[str], order: str | Column | Sequence[Column] = "row_no"
) -> DataFrame:
    """First row per key by `order`.

    Spark turns `row_number() = 1` into a group limit that runs on both sides of the shuffle.
    """
    by = [order] if isinstance(order, (str, Column)) else list(order)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*by))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def copies(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per key the first `row_no` and the number of rows, without moving the rows themselves."""
    return df.groupBy(*key).agg(
        F.min("row_no").alias("row_no"), F.count(F.lit(1)).alias("n_copies")
    )


def prefer_equity(master: DataFrame) -> DataFrame:
    """One master row per symbol: EQ (or no series) first, then the earliest listing date.

    Null rank and null date sort before all others, file order decides the rest.
    """
    order = [
        F.asc_nulls_first(F.col("series") != "EQ"),
        F.asc_nulls_first("listing_date"),
        F.asc("row_no"),
    ]
    return keep_first(master, ["symbol"], order)
