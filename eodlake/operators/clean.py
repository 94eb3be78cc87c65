"""Cleaners: raw text frame of one or many day files -> table rows and quality issues."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.model import ERROR, INGESTED, PRODUCTS, TABLES
from eodlake.operators import qc
from eodlake.operators.dedupe import copies, keep_first, prefer_equity
from eodlake.operators.normalize import typed


@dataclass(frozen=True)
class Cleaned:
    """A cleaned product. All members are lazy and share the lineage of `typed`."""

    product: str
    typed: DataFrame

    @property
    def columns(self) -> list[str]:
        """Table columns a file can fill."""
        spec = PRODUCTS[self.product]
        return [c for c in TABLES[spec.table].columns if c in spec.headers]

    @property
    def usable(self) -> DataFrame:
        """Rows with date, identifier and (F&O) expiry; duplicates still in."""
        return (
            self.typed.where(qc.usable(self.product))
            .withColumn("date", qc.resolved_date(self.product))
            .select("file_date", "row_no", *self.columns)
        )

    @property
    def file_key(self) -> list[str]:
        return ["file_date", *PRODUCTS[self.product].key]

    @property
    def rows(self) -> DataFrame:
        """First row per file and key."""
        return keep_first(self.usable, self.file_key)

    @property
    def copies(self) -> DataFrame:
        """Per file and key: first `row_no` and `n_copies`."""
        return copies(self.usable, self.file_key)

    @property
    def broken(self) -> Column:
        """A row that breaks a NOT NULL column of the table."""
        out = F.lit(False)
        for c in TABLES[PRODUCTS[self.product].table].not_null:
            if c in self.columns:
                out = out | F.col(c).isNull()
        return out

    @property
    def facts(self) -> DataFrame:
        """Per file and key: `n_copies`, and how many of them are broken.

        Only keys and flags are shuffled, and all buffers have a fixed width, so Spark aggregates by hash.
        """
        return self.usable.groupBy(*self.file_key).agg(
            F.count(F.lit(1)).alias("n_copies"), F.count_if(self.broken).alias("n_broken")
        )

    @property
    def issues(self) -> DataFrame:
        return self.issues_with(self.copies)

    def issues_with(self, copies: DataFrame) -> DataFrame:
        """All issues, by facts of the keys that are already known."""
        p = self.product
        return (
            qc.row_issues(self.typed, p)
            .unionByName(qc.count_issues(qc.file_counts(self.typed, p), p))
            .unionByName(qc.count_issues(qc.copy_counts(copies), p))
        )

    def issues_of(self, code: str) -> DataFrame:
        """Issues of one code, computing nothing else."""
        p = self.product
        if code in qc.row_codes(p):
            return qc.row_issues(self.typed, p, [code])
        if code == "DUPLICATE_ROWS":
            return qc.count_issues(qc.copy_counts(self.copies), p)
        counted = qc.count_issues(qc.file_counts(self.typed, p), p)
        return counted.where(F.col("code") == code)


def clean(raw: DataFrame, product: str, expected_day: dt.date | None = None) -> Cleaned:
    """Clean a raw frame of one layout (columns = verbatim headers).

    The frame may hold many files: `file_date` tells them apart and `row_no` orders each. A bare
    one-file frame gets both from `expected_day` and the row order.
    """
    return Cleaned(product, typed(raw, product, expected_day))


def clean_bars(raw: DataFrame, expected_day: dt.date | None = None) -> Cleaned:
    return clean(raw, "cm", expected_day)


def clean_index(raw: DataFrame, expected_day: dt.date | None = None) -> Cleaned:
    return clean(raw, "idx", expected_day)


def clean_fo(raw: DataFrame, expected_day: dt.date | None = None) -> Cleaned:
    return clean(raw, "fo", expected_day)


def clean_deliverable(raw: DataFrame, expected_day: dt.date | None = None) -> Cleaned:
    return clean(raw, "deliv", expected_day)


def clean_master(raw: DataFrame) -> DataFrame:
    """One row per symbol, EQ preferred."""
    rows = typed(raw, "master").where(F.length("symbol") > 0)
    return prefer_equity(rows).select("symbol", "name", "isin", "series", "listing_date")


def clean_layouts(frames: list[DataFrame], product: str) -> tuple[Cleaned | None, list]:
    """Clean files of several layouts together.

    Each frame holds the files of one layout. A layout that lacks a required column fails with all
    its files and leaves the others alone: the second result lists (frame, reason) of those.
    """
    good, failed = [], []
    for frame in frames:
        try:
            good.append(typed(frame, product))
        except ValueError as exc:
            failed.append((frame, str(exc)))
    if not good:
        return None, failed
    rows = good[0]
    for more in good[1:]:
        rows = rows.unionByName(more)
    return Cleaned(product, rows), failed


def file_status(cleaned: Cleaned | None, failed: list, facts: DataFrame | None = None) -> DataFrame:
    """(file_date, status, num_rows, error) of every file.

    A file fails as a whole if its layout does not fit or a row breaks a NOT NULL column; it then
    contributes no rows.
    """
    out = None
    if cleaned is not None:
        facts = cleaned.facts if facts is None else facts
        per_file = facts.groupBy("file_date").agg(
            F.count(F.lit(1)).alias("n"),
            F.bool_or(F.col("n_broken") == F.col("n_copies")).alias("broken"),
        )
        # a key with broken and whole rows: its first row decides, and only such keys are put in order
        mixed = facts.where("n_broken > 0 AND n_broken < n_copies").select(*cleaned.file_key)
        first = keep_first(cleaned.usable.join(mixed, cleaned.file_key, "left_semi"), cleaned.file_key)
        late = first.where(cleaned.broken).select("file_date").distinct().withColumn("late", F.lit(True))
        # a file without any usable row is ingested with 0 rows
        read = cleaned.typed.select("file_date").distinct()
        message = "NOT NULL constraint failed: " + PRODUCTS[cleaned.product].table
        is_broken = F.coalesce("broken", F.lit(False)) | F.coalesce("late", F.lit(False))
        out = read.join(per_file, "file_date", "left").join(late, "file_date", "left").select(
            "file_date",
            F.when(is_broken, ERROR).otherwise(INGESTED).alias("status"),
            F.when(is_broken, 0).otherwise(F.coalesce("n", F.lit(0))).cast("bigint").alias("num_rows"),
            F.when(is_broken, message).alias("error"),
        )
    for frame, reason in failed:
        bad = frame.select("file_date").distinct().select(
            "file_date",
            F.lit(ERROR).alias("status"),
            F.lit(0).cast("bigint").alias("num_rows"),
            F.lit(reason).alias("error"),
        )
        out = bad if out is None else out.unionByName(bad)
    return out
