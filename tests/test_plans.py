"""What the physical plans must look like, and that hot keys change nothing in the result."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import CM_HEADER, CM_ROWS, DAY
from pyspark.sql import functions as F
from test_store import bars

from eodlake.model import TABLES
from eodlake.operators import anomalies, clean, dedupe
from eodlake.operators import store as stores
from eodlake.plans import templates
from eodlake.session import Scratch, make_folder
from eodlake.sources import scan


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def day_file(spark, landing):
    path = landing.cm(DAY, "\n".join([CM_HEADER, *CM_ROWS]) + "\n")
    return scan.scan_plain(spark, "cm", CM_HEADER, [str(path)])


def test_cleaner_shuffles_once_and_stays_in_the_jvm(day_file):
    text = plan(clean.clean(day_file, "cm").rows)
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert "Python" not in text and "Pandas" not in text


def test_row_issues_need_no_shuffle(day_file):
    cleaned = clean.clean(day_file, "cm")
    assert "Exchange" not in plan(cleaned.issues_of("OHLC_INVALID"))


def test_duplicate_counts_move_keys_only(day_file):
    text = plan(clean.clean(day_file, "cm").issues_of("DUPLICATE_ROWS"))
    exchanged = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and "CLOSE_PRICE" not in text.split("FileScan")[1].split("ReadSchema")[1]


def test_scan_reads_only_the_columns_in_use(day_file):
    text = plan(clean.clean(day_file, "cm").typed.select("file_date", "symbol", "close"))
    schema = text.split("ReadSchema: ")[1]
    assert "SYMBOL" in schema and "CLOSE_PRICE" in schema and "OPEN_PRICE" not in schema


def test_latest_day_prunes_folders(spark, store):
    store.upsert_bars(bars(spark, [("A", 1.0, DAY), ("A", 2.0, dt.date(2024, 3, 14))]), "a.csv")
    df = templates.latest_day(store["bhav_daily"])
    filters = plan(df).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "date" in filters and "subquery" in filters.lower()
    assert df.count() == 1


def test_latest_day_of_a_store_opens_one_folder(spark, store):
    store.upsert_bars(bars(spark, [("A", 1.0, DAY), ("A", 2.0, dt.date(2024, 3, 14))]), "a.csv")
    make_folder(spark, store.path("bhav_daily") + "/date=2024-03-15")
    assert store.days("bhav_daily") == [DAY, dt.date(2024, 3, 14), dt.date(2024, 3, 15)]
    df = templates.latest_rows(store, "bhav_daily")
    filters = plan(df).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "2024-03-14" in filters and "subquery" not in filters.lower()
    assert [r.close for r in df.collect()] == [2.0]


@pytest.mark.parametrize(("wanted", "last"), [(1, 1), (2, 4), (4, 4), (5, None), (99, None)])
def test_earliest_rows_stop_at_the_day_that_fills_them(spark, store, wanted, last):
    days = [DAY + dt.timedelta(i) for i in range(7)]
    store.upsert_bars(bars(spark, [("A", 1.0, d) for d in days]), "a.csv")
    df = templates.earliest_rows(store, ("bhav_daily",), wanted, lambda t: t["bhav_daily"])
    assert sorted(r.date for r in df.collect()) == days[:last]


def test_date_range_prunes_folders(spark, store):
    store.upsert_bars(bars(spark, [("A", 1.0, DAY)]), "a.csv")
    text = plan(store.table("bhav_daily", DAY, DAY).where("symbol = 'A'"))
    assert "PartitionFilters: [isnotnull(date" in text
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,A)]" in text


def test_a_day_load_does_not_shuffle_stored_rows(spark, store):
    store.upsert_bars(bars(spark, [(f"S{i}", 1.0, DAY) for i in range(50)]), "a.csv")
    table = TABLES["bhav_daily"]
    with Scratch(spark) as scratch:
        new = scratch.write(stores.conform(bars(spark, [("S1", 2.0, DAY)]), table))
        text = plan(stores.merge(store["bhav_daily"], new, table))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_load_falls_back_to_sort_merge(spark, store):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.upsert_bars(bars(spark, [(f"S{i}", 1.0, DAY) for i in range(50)]), "a.csv")
        store.upsert_bars(bars(spark, [(f"S{i}", 2.0, DAY) for i in range(10, 60)]), "b.csv")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = {r.close: r.n for r in store["bhav_daily"].groupBy("close").agg(F.count("*").alias("n")).collect()}
    assert got == {1.0: 10, 2.0: 50}


def test_one_key_with_a_third_of_all_rows(spark):
    """Keep-first and copy counts against brute force, a hot key and many small ones."""
    n = 30_000
    df = spark.range(n).select(
        F.lit(DAY).alias("file_date"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("S"), (F.col("id") % 977).cast("string"))
        ).alias("symbol"),
        ((F.col("id") * 7919) % n).alias("row_no"),
    ).repartition(8)
    first, count = {}, {}
    for r in df.collect():
        first[r.symbol] = min(first.get(r.symbol, n), r.row_no)
        count[r.symbol] = count.get(r.symbol, 0) + 1
    key = ["file_date", "symbol"]
    kept = dedupe.keep_first(df, key)
    assert {r.symbol: r.row_no for r in kept.collect()} == first
    assert {r.symbol: r.n_copies for r in dedupe.copies(df, key).collect()} == count
    assert "WindowGroupLimit" in plan(kept)


def test_anomaly_samples_of_a_frequent_code(spark):
    """Only a few rows of each code per task reach the shuffle."""
    found = spark.range(20_000).select(
        F.when(F.col("id") < 19_990, "EXTREME_MOVE").otherwise("NEGATIVE_PRICE").alias("code"),
        F.date_add(F.lit(DAY), (F.col("id") % 50).cast("int")).alias("date"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("symbol"),
        F.lit("EQ").alias("series"),
        F.array().cast("array<struct<name:string,value:string>>").alias("sample"),
    )
    samples = anomalies.anomaly_samples(found)
    assert plan(samples).count("WindowGroupLimit") == 2
    got = [(r.code, r.ord) for r in samples.orderBy("code", "ord").collect()]
    assert got == [(c, i) for c in ("EXTREME_MOVE", "NEGATIVE_PRICE") for i in range(1, 6)]
