"""Landing folder -> (product, day) files, and what to do with each day.

A day file lies at <root>/<product>/<YYYY>/<MON>/<name>. It may also be a folder of that name with
part files, each with its own header; that is how days too large for one file arrive. Listing never
reads content.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.model import INGESTED
from eodlake.session import exists

# File names per product as (pattern, date format, text before the date, text after).
FILE_NAMES = {
    "cm": (r"cm(\d{2}[A-Z]{3}\d{4})bhav\.csv(?:\.zip)?", "ddMMMyyyy", "cm", "bhav.csv"),
    "fo": (r"fo(\d{2}[A-Z]{3}\d{4})bhav\.csv\.zip", "ddMMMyyyy", "fo", "bhav.csv.zip"),
    "idx": (r"ind_close_all_(\d{8})\.csv", "ddMMyyyy", "ind_close_all_", ".csv"),
    "deliv": (
        r"sec_bhavdata_full_(\d{8})\.csv", "ddMMyyyy", "sec_bhavdata_full_", ".csv",
    ),
}

_PLACE = r"/(cm|fo|idx|deliv)/(\d{4})/([A-Z]{3})/([^/]+)(?:/[^/]+)?$"


def _piece(path: Column, group: int) -> Column:
    return F.regexp_extract(path, _PLACE, group)


def day_file_name(product: str, day: Column) -> Column:
    """Conventional (unzipped, except F&O) name of a day's file."""
    _, date_format, before, after = FILE_NAMES[product]
    return F.concat(F.lit(before), F.upper(F.date_format(day, date_format)), F.lit(after))


def day_of_path(path: Column, product: str) -> Column:
    """The day a file claims, null if its name or place does not fit."""
    pattern, date_format, _, _ = FILE_NAMES[product]
    name = _piece(path, 4)
    day = F.try_to_date(F.regexp_extract(name, f"^{pattern}$", 1), date_format)
    placed = (_piece(path, 1) == product) & (
        F.concat(_piece(path, 2), _piece(path, 3)) == F.upper(F.date_format(day, "yyyyMMM"))
    )
    return F.when(placed, day)


def claimed_day(path: Column, product: str) -> Column:
    """The day of a path that `resolve_files` has accepted: its place is fixed, so cutting it out
    costs no pattern match per row."""
    _, date_format, before, _ = FILE_NAMES[product]
    below = F.substring_index(path, f"/{product}/", -1)  # YYYY/MON/<name>
    text = F.substring(below, len("YYYY/MON/") + len(before) + 1, len(date_format))
    return F.try_to_date(text, date_format)


def month_folders(root: str, product: str, days: Iterable[dt.date]) -> list[str]:
    """The only folders that can hold files of these days."""
    months = sorted({d.replace(day=1) for d in days})
    return [f"{root.rstrip('/')}/{product}/{m:%Y}/{f'{m:%b}'.upper()}" for m in months]


def list_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(path, length) of every file below the folders that exist.

    A scan skips files of length 0, so those come from the names in the listing.
    """
    present = [r for r in roots if exists(spark, r)]
    if not present:
        return spark.createDataFrame([], "path string, length bigint")
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(present)
    sized = scan.select("path", "length", F.regexp_extract("path", _PLACE, 0).alias("place"))
    named = spark.createDataFrame([(f,) for f in scan.inputFiles()], "path string").withColumn(
        "place", F.regexp_extract("path", _PLACE, 0)
    )
    empty = named.join(sized, "place", "left_anti").select("path", F.lit(0).alias("length"))
    return sized.select("path", "length").unionByName(empty)


def resolve_files(paths: DataFrame) -> DataFrame:
    """(product, date, name, zipped, path, ...) of the files whose name and place fit.

    Where a day has both a plain and a zipped file, the plain one counts.
    """
    path = F.col("path")
    product = _piece(path, 1)
    day = None
    for code in FILE_NAMES:
        branch = day_of_path(path, code)
        day = F.when(product == code, branch) if day is None else day.when(product == code, branch)
    named = paths.select(
        product.alias("product"),
        day.alias("date"),
        _piece(path, 4).alias("name"),
        F.endswith(path, F.lit(".zip")).alias("zipped"),
        *paths.columns,
    ).where(F.col("date").isNotNull())
    preferred = named.groupBy("product", "date").agg(F.min("zipped").alias("zipped"))
    return named.join(preferred, ["product", "date", "zipped"])


def fingerprint(content: Column) -> Column:
    return F.sha2(content, 256)


def day_fingerprints(parts: DataFrame) -> DataFrame:
    """One row per (product, date) of resolved, fingerprinted parts.

    A single file keeps its own hash; a folder of parts gets the hash of their hashes in name
    order. One part without a hash leaves the day without.
    """
    hashes = F.transform(
        F.array_sort(F.collect_list(F.struct("path", F.coalesce("sha256", F.lit(""))))),
        lambda p: p["col2"],
    )
    return parts.groupBy("product", "date").agg(
        F.min("name").alias("name"),
        F.count(F.lit(1)).alias("n_parts"),
        F.bool_and(F.col("sha256").isNotNull()).alias("hashed"),
        hashes.alias("hashes"),
        F.min("error").alias("error"),
    ).select(
        "product", "date", "name", "n_parts", "error",
        F.when(
            F.col("hashed"),
            F.when(F.col("n_parts") == 1, F.col("hashes")[0]).otherwise(
                F.sha2(F.array_join("hashes", ","), 256)
            ),
        ).alias("sha256"),
    )


def pending_days(days: DataFrame, log: DataFrame, force: bool = False) -> DataFrame:
    """Days whose content is not yet ingested; `force` takes all, a null hash never skips."""
    if force:
        return days
    done = log.where(F.col("status") == INGESTED).select("product", "date", "sha256")
    return days.join(done, ["product", "date", "sha256"], "left_anti")


def non_trading_days(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """Candidate (product, date) rows for which no file has arrived."""
    return candidates.join(files.select("product", "date"), ["product", "date"], "left_anti")
