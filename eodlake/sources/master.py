"""Equity master file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.sources.files import list_files
from eodlake.sources.scan import CSV_OPTIONS, EMPTY, header_fields, inspect, text_schema


def inspect_master(spark: SparkSession, path: str) -> DataFrame:
    """The parts of the master with (sha256, header, breaks, error), one row per file."""
    return inspect(spark, list_files(spark, [path]).withColumn("zipped", F.lit(False)))


def scan_master(spark: SparkSession, path: str, parts: DataFrame | None = None) -> DataFrame:
    """All-text frame of the master CSV with `row_no`; raises ValueError if it cannot be read."""
    found = (inspect_master(spark, path) if parts is None else parts).orderBy("path").collect()  # a row per file
    wrong = "cannot be found" if not found else next((r.error for r in found if r.error not in (None, EMPTY)), None)
    used = [r for r in found if r.error is None]
    if wrong or not used:
        raise ValueError(f"failed to read equity master {path}: {wrong or EMPTY}")
    schema = text_schema(header_fields(used[0].header))
    breaks = any(r.breaks for r in used)
    df = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=breaks).csv([r.path for r in used])
    order = F.struct(
        F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return df.select(order.alias("row_no"), "*")
