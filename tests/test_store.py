from __future__ import annotations

import datetime as dt

import pytest
from conftest import CM_CSV, DAY, DELIV_CSV, rows_of
from pyspark.sql import functions as F

from eodlake.model import SCHEMA_VERSION, TABLES
from eodlake.operators.clean import clean_bars, clean_deliverable
from eodlake.operators.store import Store


def bars(spark, rows):
    """(symbol, close, day) -> bars."""
    return spark.createDataFrame(rows, "symbol string, close double, date date").selectExpr(
        "symbol", "'EQ' AS series", "date", "close", "1L AS total_traded_quantity",
        "1.0D AS turnover", "1L AS no_of_trades", "0L AS delivery_qty", "0.0D AS delivery_pct",
    )


def test_create_is_idempotent(store):
    assert store.schema_version == SCHEMA_VERSION
    store.create_tables()
    assert store["schema_migrations"].count() == 1
    assert store.list_tables() == sorted(TABLES)


def test_upsert_twice_is_upsert_once(spark, store):
    rows = bars(spark, [("A", 1.0, DAY), ("B", 2.0, DAY)])
    assert store.upsert_bars(rows, "a.csv") == store.upsert_bars(rows, "a.csv") == 2
    assert store["bhav_daily"].count() == 2


def test_upsert_replaces_and_keeps_the_first_load_time(spark, store):
    store.upsert_bars(bars(spark, [("A", 1.0, DAY), ("B", 2.0, DAY)]), "a.csv")
    loaded = {r.symbol: r.ingested_at for r in store["bhav_daily"].collect()}
    store.upsert_bars(bars(spark, [("A", 9.0, DAY)]), "b.csv")
    rows = {r.symbol: r for r in store["bhav_daily"].collect()}
    assert (rows["A"].close, rows["A"].source_file) == (9.0, "b.csv")
    assert (rows["B"].close, rows["B"].source_file) == (2.0, "a.csv")
    assert {s: r.ingested_at for s, r in rows.items()} == loaded


def test_upsert_touches_only_its_days(spark, store, tmp_path):
    other = dt.date(2024, 3, 14)
    store.upsert_bars(bars(spark, [("A", 1.0, DAY), ("A", 2.0, other)]), "a.csv")
    folder = tmp_path / "store" / "bhav_daily" / f"date={other}"
    before = sorted(p.name for p in folder.iterdir())
    store.upsert_bars(bars(spark, [("A", 5.0, DAY)]), "b.csv")
    assert sorted(p.name for p in folder.iterdir()) == before
    assert rows_of(store["bhav_daily"], "date", "close") == [(DAY, 5.0), (other, 2.0)]


def test_later_file_wins_across_days(spark, store):
    rows = bars(spark, [("A", 1.0, DAY), ("A", 2.0, DAY), ("A", 3.0, DAY)]).withColumn(
        "row_no", F.col("close").cast("bigint")
    ).withColumn("file_date", F.when(F.col("close") == 1, F.lit(DAY)).otherwise(F.date_add(F.lit(DAY), 1)))
    store.upsert_bars(rows, "x.csv")
    assert rows_of(store["bhav_daily"], "close") == [(2.0,)]


def test_null_in_not_null_column_is_refused(spark, store):
    rows = bars(spark, [("A", 1.0, DAY)]).withColumn("turnover", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="null in"):
        store.upsert_bars(rows, "a.csv")
    assert store["bhav_daily"].count() == 0


def test_no_rows(spark, store):
    assert store.upsert_bars(bars(spark, []), "a.csv") == 0


def test_deliverable_key_has_series(raw, store):
    store.upsert_deliverable(clean_deliverable(raw(DELIV_CSV), DAY).rows, "d.csv")
    assert store["deliverable_daily"].where("symbol = 'HERON'").count() == 2


def test_master_keeps_columns_no_file_fills(spark, store):
    s = "symbol string, name string, isin string, series string, listing_date date"
    store.upsert("equity_master", spark.createDataFrame([("A", "Energy")], "symbol string, industry string"))
    store.upsert_master(spark.createDataFrame([("A", "Alpha", "I1", "EQ", None)], s))
    row = store["equity_master"].first()
    assert (row["name"], row.industry, row.status) == ("Alpha", "Energy", "listed")


def test_log_keeps_the_newest_attempt(spark, store):
    schema = "product string, date date, status string, error string"
    store.write_ingest_log(spark.createDataFrame([("cm", DAY, "ingested", None)], schema))
    store.write_ingest_log(spark.createDataFrame([("cm", DAY, "error", "boom")], schema))
    assert rows_of(store["ingest_log"], "status", "error", "num_rows") == [("error", "boom", 0)]


def test_issues_of_a_day_are_replaced(raw, spark, store):
    schema = "product string, date date, symbol string, code string, message string"
    slices = spark.createDataFrame([("cm", DAY)], "product string, date date")
    store.write_qc_issues(spark.createDataFrame([("cm", DAY, "A", "X", "m"), ("idx", DAY, "N", "X", "m")], schema))
    store.write_qc_issues(spark.createDataFrame([("cm", DAY, "B", "Y", "m")], schema), slices)
    assert rows_of(store["qc_issues"], "product", "symbol") == [("cm", "B"), ("idx", "N")]
    store.write_qc_issues(spark.createDataFrame([], schema), slices)
    assert rows_of(store["qc_issues"], "product", "symbol") == [("idx", "N")]


def test_gaps_are_replaced_and_cleared(spark, store):
    schema = "product string, date date, gap_type string, detail string"
    rows = spark.createDataFrame([("cm", DAY, "missing_attempt", "x")], schema)
    other = spark.createDataFrame([("fo", DAY, "missing_attempt", "x")], schema)
    assert store.refresh_gaps("cm", rows) == 1
    assert store.refresh_gaps("fo", other) == 1
    assert store.refresh_gaps("cm", rows.limit(0)) == 0
    assert rows_of(store["data_gaps"], "product") == [("fo",)]


def test_older_store_is_rekeyed(spark, tmp_path):
    root = str(tmp_path / "old")
    old = Store(spark, root).create_tables()
    spark.createDataFrame([(1,)], "version int").selectExpr(
        "version", "current_timestamp() AS applied_at"
    ).write.mode("overwrite").parquet(old.path("schema_migrations"))
    schema = "symbol string, series string, date date, quantity_traded bigint, delivery_quantity bigint, source_file string"
    old.upsert("deliverable_daily", spark.createDataFrame(
        [("A", "", DAY, 10, 8, "o.csv"), ("B", "N1", DAY, 5, 5, "o.csv")], schema
    ))
    again = Store(spark, root).create_tables()
    assert again.schema_version == 2
    assert rows_of(again["deliverable_daily"], "symbol", "series", "delivery_quantity") == [
        ("A", "EQ", 8), ("B", "N1", 5)
    ]


def test_keys_are_unique_after_loads(raw, store):
    rows = clean_bars(raw(CM_CSV), DAY).rows
    store.upsert_bars(rows, "a.csv")
    store.upsert_bars(rows.withColumn("close", F.lit(1.0)), "b.csv")
    keys = store["bhav_daily"].select(*TABLES["bhav_daily"].key)
    assert keys.count() == keys.distinct().count() == 3
