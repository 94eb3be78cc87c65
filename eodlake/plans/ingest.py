"""Ingest job: all pending days of all products in one pass.

list -> resolve -> hash -> skip what the log has -> scan quotes and headers -> per product: clean, gate per file,
upsert -> quality issues -> log. The log is written last, so a run that dies is simply repeated.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from eodlake.functions.calendar import days_between, is_trading_day
from eodlake.model import DAILY_PRODUCTS, ERROR, INGESTED, NON_TRADING, PRODUCTS, SKIPPED
from eodlake.operators.clean import Cleaned, clean_layouts, clean_master, file_status
from eodlake.operators.anomalies import master_drift
from eodlake.operators.layout import match_headers
from eodlake.operators.store import Store, last_file_first
from eodlake.session import Scratch
from eodlake.sources import files, scan
from eodlake.sources.master import inspect_master, scan_master

NO_ROWS = "no rows parsed"


@dataclass(frozen=True)
class IngestSummary:
    product: str
    ingested: int = 0
    skipped: int = 0
    non_trading: int = 0
    errors: int = 0
    rows: int = 0


def ingest_summary(outcomes: DataFrame) -> DataFrame:
    """Per product: days by outcome and rows ingested."""
    status = F.col("status")
    return outcomes.groupBy("product").agg(
        F.count_if(status == INGESTED).alias("ingested"),
        F.count_if(status == SKIPPED).alias("skipped"),
        F.count_if(status == NON_TRADING).alias("non_trading"),
        F.count_if(status == ERROR).alias("errors"),
        F.coalesce(F.sum(F.when(status == INGESTED, F.col("num_rows"))), F.lit(0)).alias("rows"),
    )


def _layout_errors(spark: SparkSession, layouts: list[tuple[str, str]]) -> DataFrame:
    """(product, header, reason) of layouts that cannot be used."""
    reasons = []
    for product, header in layouts:
        try:
            match_headers(product, scan.header_fields(header))
        except ValueError as exc:
            reasons.append((product, header, str(exc)))
    return spark.createDataFrame(reasons, "product string, header string, reason string")


_STATUS = "product string, date date, status string, num_rows bigint, error string"


def _load(store: Store, scratch: Scratch, product: str, groups: list[scan.FileGroup], names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Load the files of one product: status per day, and the issues of the days that were ingested."""
    cleaned, _ = clean_layouts(scan.scan_raw(store.spark, product, groups), product)
    # parsed once, as text; everything below reads the columns it needs from Parquet
    cleaned = Cleaned(product, scratch.write(cleaned.typed))
    facts = scratch.write(cleaned.facts)
    status = scratch.write(file_status(cleaned, [], facts))
    good = status.where(F.col("status") == INGESTED).select("file_date")
    named = good.join(names.where(F.col("product") == product).drop("product"), "file_date")
    rows = cleaned.usable.join(named, "file_date")
    issues = cleaned.issues_with(facts).join(good, "file_date").select(
        F.lit(product).alias("product"), F.col("file_date").alias("date"),
        "symbol", "series", "code", "message",
    )
    _, issues = side_by_side(store.spark, [
        lambda: store.upsert(PRODUCTS[product].table, rows, last_file_first()), lambda: scratch.write(issues)
    ])
    return status.select(F.lit(product).alias("product"), F.col("file_date").alias("date"), "status", "num_rows", "error"), issues


def side_by_side(spark: SparkSession, tasks: list[Callable]) -> list:
    """Run loads that share no table at the same time, so that the end of one's jobs is not idle time."""
    if len(tasks) < 2:
        return [task() for task in tasks]
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [r.result() for r in running]


def update_days(
    store: Store, landing: str, days: dict[str, Iterable[dt.date]], force: bool = False
) -> list[IngestSummary]:
    """Ingest several products, each over candidate days, from a landing folder.

    One listing, one pass of hashes, one scan of quotes and headers, one log and one write of issues serve all
    products; their tables are loaded at the same time. A day whose content is already in the log is skipped unless
    `force`; a day without a file is logged as non-trading; a file that cannot be used is logged as an error and
    stops nothing else.
    """
    for product in days:
        if product not in DAILY_PRODUCTS:
            raise ValueError(f"unknown product {product!r}; must be one of {DAILY_PRODUCTS}")
    started = time.monotonic()
    days = {p: sorted(set(d)) for p, d in days.items()}
    spark = store.spark
    rows = [(p, d) for p, some in days.items() for d in some]
    if not rows:
        return [IngestSummary(p) for p in days]
    candidates = spark.createDataFrame(rows, "product string, date date")
    with Scratch(spark) as scratch:
        listed = files.list_files(spark, [f for p, some in days.items() for f in files.month_folders(landing, p, some)])
        wanted = scratch.write(files.resolve_files(listed).join(candidates, ["product", "date"], "left_semi"))
        hashed = scratch.write(scan.fingerprints(spark, wanted))
        # day facts as tables: known sizes let Spark broadcast them, and the log may change below
        found = scratch.write(files.day_fingerprints(hashed))
        pending = scratch.write(files.pending_days(found, store["ingest_log"], force))
        # only files of pending days are read further; archives are unpacked on the way
        fresh = hashed.join(pending.where(F.col("error").isNull()).select("product", "date"), ["product", "date"], "left_semi")
        parts = scratch.write(scan.look(spark, scratch.write(fresh.drop("error")), scratch.folder()))
        layouts = parts.where(F.col("error").isNull()).select("product", "header").distinct().collect()
        bad = _layout_errors(spark, [tuple(r) for r in layouts])
        parts = scratch.write(
            parts.join(bad, ["product", "header"], "left").withColumn("error", F.coalesce("error", "reason")).drop("reason")
        )
        # one unusable part fails its day
        faults = parts.where(F.col("error").isNotNull()).groupBy("product", "date").agg(F.min("error").alias("fault"))
        usable = scratch.write(parts.join(faults, ["product", "date"], "left_anti"))
        groups = scan.groups_by_product(usable)
        names = usable.select("product", F.col("date").alias("file_date"), F.col("name").alias("source_file")).distinct()
        loads = [lambda p=p: _load(store, scratch, p, groups[p], names) for p in days if p in groups]
        loaded = spark.createDataFrame([], _STATUS)
        done = side_by_side(spark, loads)
        for status, _ in done:
            loaded = loaded.unionByName(status)
        if done:
            issues = done[0][1]
            for _, more in done[1:]:
                issues = issues.unionByName(more)
            store.write_qc_issues(issues, loaded.where(F.col("status") == INGESTED).select("product", "date"))
        attempted = (
            pending.withColumnRenamed("error", "_error")
            .join(faults, ["product", "date"], "left")
            .join(loaded, ["product", "date"], "left")
        )
        no_rows = F.col("status").isNull()
        attempts = attempted.select(
            "product", "date", F.col("name").alias("file_name"), "sha256",
            F.lit(landing).alias("source_url"),
            F.coalesce("num_rows", F.lit(0)).alias("num_rows"),
            F.when(no_rows, ERROR).otherwise(F.col("status")).alias("status"),
            F.when(no_rows, F.coalesce("_error", "fault", F.lit(NO_ROWS)))
            .otherwise(F.col("error")).alias("error"),
        )
        missing = files.non_trading_days(candidates, found).select(
            "product", "date", F.lit(NON_TRADING).alias("status"), F.lit(0).alias("num_rows")
        )
        skipped = found.join(pending, ["product", "date"], "left_anti").select(
            "product", "date", F.lit(SKIPPED).alias("status"), F.lit(0).alias("num_rows")
        )
        outcomes = scratch.write(
            attempts.unionByName(missing, allowMissingColumns=True)
            .unionByName(skipped, allowMissingColumns=True)
            .withColumn("duration_sec", F.lit(time.monotonic() - started))
        )
        store.write_ingest_log(outcomes.where(F.col("status") != SKIPPED))
        summaries = {r["product"]: IngestSummary(**r.asDict()) for r in ingest_summary(outcomes).collect()}
    return [summaries.get(p, IngestSummary(p)) for p in days]


def update_product(
    store: Store,
    landing: str,
    product: str,
    days: Iterable[dt.date],
    force: bool = False,
) -> IngestSummary:
    """Ingest one product over candidate days from a landing folder, as `update_days` does."""
    return update_days(store, landing, {product: days}, force)[0]


def trading_days_of(store: Store, start: dt.date, end: dt.date) -> list[dt.date]:
    """Candidate days of a range, on the driver: a calendar, not data."""
    if end < start:
        return []
    days = days_between(store.spark, start, end).where(is_trading_day(F.col("date")))
    return [r.date for r in days.orderBy("date").collect()]


def update(
    store: Store,
    landing: str,
    start: dt.date,
    end: dt.date,
    products: Iterable[str] = ("cm",),
    force: bool = False,
) -> list[IngestSummary]:
    """Ingest the trading-day candidates of a range; also the way to backfill, as reruns resume."""
    products = list(products)
    unknown = [p for p in products if p not in DAILY_PRODUCTS]
    if unknown:
        raise ValueError(f"{unknown} not implemented (datasets: {', '.join(DAILY_PRODUCTS)})")
    days = trading_days_of(store, start, end)
    return update_days(store, landing, dict.fromkeys(products, days), force)


def refresh_master(store: Store, path: str, today: dt.date | None = None) -> dict:
    """Load the equity master file and report EQ symbols that have bars but no master row."""
    started = time.monotonic()
    spark = store.spark
    with Scratch(spark) as scratch:
        parts = scratch.write(inspect_master(spark, path))
        rows = scratch.write(clean_master(scan_master(spark, path, parts)))
        n = store.upsert_master(rows)
        # a folder of parts gets the hash of the hashes, like a day file
        sha = parts.select(
            F.lit("master").alias("product"), F.lit(today or dt.date.today()).alias("date"),
            F.lit(path.rstrip("/").rsplit("/", 1)[-1]).alias("name"),
            F.lit(None).cast("string").alias("error"), "path", "sha256",
        )
        store.write_ingest_log(
            files.day_fingerprints(sha).select(
                "product", "date", F.col("name").alias("file_name"), "sha256",
                F.lit(path).alias("source_url"), F.lit(n).cast("bigint").alias("num_rows"),
                F.lit(INGESTED).alias("status"),
                F.lit(time.monotonic() - started).alias("duration_sec"),
            )
        )
    drift = master_drift(store["bhav_daily"], store["equity_master"])
    return {"rows": n, "drift": drift, "drift_count": drift.count()}
