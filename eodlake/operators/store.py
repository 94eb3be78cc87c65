"""Stored tables: Parquet folders, the daily ones partitioned by date.

Every daily key contains `date`, so an upsert reads and rewrites only the days it touches, and a
date predicate in any query prunes folders without help. Days are replaced whole (`commit.py`).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eodlake.model import SCHEMA_VERSION, TABLES, Table
from eodlake.operators.commit import Stage, leaves, recover
from eodlake.operators.dedupe import keep_first
from eodlake.session import Scratch, folders, make_folder, recover_folder, replace_folder

_LOAD_TIMES = ("ingested_at", "updated_at", "applied_at", "generated_at")


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Table columns by name and type; absent ones null, absent load times now."""
    columns = []
    for field in table.schema:
        if field.name in df.columns:
            value = F.col(field.name).cast(field.dataType)
        elif field.name in _LOAD_TIMES:
            value = F.current_timestamp()
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def last_file_first() -> list[Column]:
    """Order in which the first row is the one that wins: latest file, then file order."""
    return [F.desc("file_date"), F.asc("row_no")]


def last_writer(rows: DataFrame, table: str) -> DataFrame:
    """State of a table after loading cleaned files day by day: the later file wins its keys."""
    return keep_first(rows, TABLES[table].key, last_file_first())


def merge(old: DataFrame, new: DataFrame, table: Table) -> DataFrame:
    """Rows of `old` whose key is not in `new`, plus `new` with the carried columns kept.

    `new` has unique keys. All joins are on the key with `new` as the side that may be broadcast,
    so a day's load does not shuffle the stored rows; larger loads fall back to a sort-merge join.
    """
    key = list(table.key)
    kept = old.join(new.select(*key), key, "left_anti")
    before = old.select(*key, *[F.col(c).alias(f"_old_{c}") for c in table.carried]).join(
        new.select(*key), key, "left_semi"
    )
    replaced = new.join(before, key, "left").select(
        *[
            F.coalesce(f"_old_{c}", c).alias(c) if c in table.carried else F.col(c)
            for c in table.columns
        ]
    )
    return kept.select(*table.columns).unionByName(replaced)


class Store:
    """Tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- definition ----

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create_tables(self) -> Store:
        """Create what is missing and bring an older store to the current version."""
        for name in TABLES:
            recover_folder(self.spark, self.path(name))
            if TABLES[name].partition:
                recover(self.spark, self.root, name, TABLES[name].partition)
            make_folder(self.spark, self.path(name))
        version = self.schema_version
        if version == SCHEMA_VERSION:
            return self
        if version is not None:
            self.rekey_deliverable(self.table("deliverable_daily"))
        row = self.spark.createDataFrame([(SCHEMA_VERSION,)], "version int")
        table = TABLES["schema_migrations"]
        conform(row, table).write.mode("append").parquet(self.path(table.name))
        return self

    @property
    def schema_version(self) -> int | None:
        return self.table("schema_migrations").agg(F.max("version")).first()[0]

    def list_tables(self) -> list[str]:
        return sorted(TABLES)

    # ---- reading ----

    def table(
        self, name: str, start: dt.date | None = None, end: dt.date | None = None
    ) -> DataFrame:
        table = TABLES[name]
        df = self.spark.read.schema(table.schema).parquet(self.path(name)).select(*table.columns)
        if start is not None:
            df = df.where(F.col("date") >= F.lit(start))
        if end is not None:
            df = df.where(F.col("date") <= F.lit(end))
        return df

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def days(self, name: str) -> list[dt.date]:
        """Days that a table partitioned by date has a folder for, in order; no file is opened."""
        found = [f.partition("date=")[2] for f in folders(self.spark, self.path(name)) if f.startswith("date=")]
        return sorted(dt.date.fromisoformat(d) for d in found if d[:1].isdigit())

    def register_views(self) -> None:
        """Make every table available to SQL under its own name."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)

    # ---- writing ----

    def _stage(self, table: Table) -> Stage:
        recover(self.spark, self.root, table.name, table.partition)
        return Stage(self.spark, self.root, table.name, table.partition)

    def upsert(
        self, name: str, staged: DataFrame, winner: Column | list[Column] | None = None
    ) -> int:
        """Replace by primary key; returns the number of rows staged after deduplication.

        `winner` orders rows of equal key, first wins; without it the keys must be unique. The rows are written once,
        where they are counted and checked on the way. Partitions not stored before are then in place but for a
        move; the others are merged with what is stored.
        """
        table = TABLES[name]
        if winner is not None:
            staged = keep_first(staged, list(table.key), winner)
        broken = F.lit(False)
        for c in table.not_null:
            broken = broken | F.col(c).isNull()
        seen = Observation()
        new = conform(staged, table).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("broken"))
        if not table.partition:
            return self._replace(table, new, seen)
        with self._stage(table) as stage:
            touched = stage.write(new, table.key)
            if not touched:
                return 0
            self._refuse(table, seen)
            stored = set(leaves(self.spark, self.path(name), len(table.partition)))
            both = [leaf.partition("=")[2] for leaf in touched if leaf in stored]
            if both:
                column = table.partition[0]
                here = F.col(column).isin([F.lit(v).cast(table.schema[column].dataType) for v in both])
                again = self.spark.read.schema(table.schema).parquet(stage.new).where(here)
                stage.write(merge(self.table(name).where(here), again, table), table.key, "merged")
                stage.replace("merged")
            stage.commit()
        return seen.get["n"]

    def _refuse(self, table: Table, seen: Observation) -> None:
        if seen.get["broken"]:
            raise ValueError(f"{table.name}: {seen.get['broken']} rows with null in {table.not_null}")

    def _replace(self, table: Table, new: DataFrame, seen: Observation) -> int:
        """A table without partitions is written whole beside its place, then moved there."""
        with Scratch(self.spark) as scratch:
            new = scratch.write(new)
            self._refuse(table, seen)
            if seen.get["n"]:
                fresh = f"{self.path(table.name)}.new-{uuid.uuid4().hex}"
                merge(self.table(table.name), new, table).write.parquet(fresh)
                replace_folder(self.spark, fresh, self.path(table.name))
        return seen.get["n"]

    def _upsert_file(self, name: str, df: DataFrame, source_file: str | None) -> int:
        if source_file is not None:
            df = df.withColumn("source_file", F.lit(source_file))
        # cleaned frames of many files come with the columns that tell which one wins
        many = {"file_date", "row_no"} <= set(df.columns)
        return self.upsert(name, df, last_file_first() if many else None)

    def upsert_bars(self, df: DataFrame, source_file: str | None = None) -> int:
        return self._upsert_file("bhav_daily", df, source_file)

    def upsert_index(self, df: DataFrame, source_file: str | None = None) -> int:
        return self._upsert_file("index_daily", df, source_file)

    def upsert_fo(self, df: DataFrame, source_file: str | None = None) -> int:
        return self._upsert_file("fo_daily", df, source_file)

    def upsert_deliverable(self, df: DataFrame, source_file: str | None = None) -> int:
        return self._upsert_file("deliverable_daily", df, source_file)

    def upsert_master(self, df: DataFrame) -> int:
        return self.upsert("equity_master", df.withColumn("status", F.lit("listed")))

    def write_ingest_log(self, rows: DataFrame) -> int:
        """One row per (product, date); the newest attempt replaces the earlier one."""
        if "num_rows" not in rows.columns:
            rows = rows.withColumn("num_rows", F.lit(0))
        return self.upsert("ingest_log", rows)

    def write_qc_issues(self, issues: DataFrame, slices: DataFrame | None = None) -> None:
        """Write issues, replacing those of every (product, date) in `slices` (default: their own).

        A slice without new issues ends up empty.
        """
        table = TABLES["qc_issues"]
        with self._stage(table) as stage:
            found = stage.write(conform(issues, table), table.key)
            if slices is not None:  # bounded by the calendar
                slices = [f"product={r.product}/date={r.date}" for r in slices.select("product", "date").distinct().collect()]
                stored = set(leaves(self.spark, self.path(table.name), 2)) if slices else set()
                for leaf in set(slices) & stored - set(found):
                    stage.empty(leaf)
            stage.commit()

    def refresh_gaps(self, product: str, rows: DataFrame) -> int:
        """Replace all gap rows of one product; no rows clears them."""
        table = TABLES["data_gaps"]
        target = f"{self.path('data_gaps')}/product={product}"
        conform(rows, table).drop("product").write.mode("overwrite").parquet(target)
        return self.table("data_gaps").where(F.col("product") == product).count()

    def rekey_deliverable(self, legacy: DataFrame) -> int:
        """Bring rows keyed by (symbol, date) under (symbol, series, date); no series means EQ."""
        rows = legacy.withColumn("series", default_series(F.col("series")))
        table = TABLES["deliverable_daily"]
        newest = F.desc("ingested_at") if "ingested_at" in legacy.columns else F.lit(0)
        seen = Observation()
        rekeyed = conform(keep_first(rows, table.key, newest), table).observe(seen, F.count(F.lit(1)).alias("n"))
        with self._stage(table) as stage:
            if not stage.write(rekeyed, table.key):
                return 0
            stage.commit()
        return seen.get["n"]


def default_series(series: Column) -> Column:
    return F.coalesce(F.nullif(series, F.lit("")), F.lit("EQ"))
