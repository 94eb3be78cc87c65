from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from eodlake.operators import coverage
from eodlake.plans import report

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
BAR = (
    "symbol string, series string, date date, prev_close double, close double, "
    "total_traded_quantity bigint, no_of_trades bigint, delivery_qty bigint"
)


@pytest.fixture(scope="module")
def tables(spark):
    d = lambda n: dt.date(2024, 1, n)
    bars = [("ALPHA", "EQ", d(n), 100.0, 100.0 + n, 1000, 10, 0) for n in (2, 3)]
    bars += [
        ("ALPHA", "EQ", d(4), 100.0, 101.0, 1000, 10, 900),
        ("JUMP", "EQ", d(3), 100.0, 300.0, 1000, 10, 0),
        ("JUMP", "BE", d(3), 100.0, 300.0, 1000, 10, 0),
        ("STILL", "EQ", d(2), 50.0, 50.0, 0, 5, 0),
        ("MINUS", "EQ", d(2), 0.0, -1.0, 5, 5, 0),
    ]
    frame = spark.createDataFrame(bars, BAR)
    for c in ("open", "high", "low"):
        frame = frame.withColumn(c, F.col("close"))
    log = [("cm", d(n), "ingested") for n in (2, 3, 4)]
    log += [("cm", d(5), "error"), ("cm", d(31), "not_a_trading_day"), ("cm", d(26), "not_a_trading_day")]
    index = [("NIFTY 50", d(2), 1.0), ("NIFTY 50", d(3), 1.0)]
    deliv = [("ALPHA", "EQ", d(4), 800), ("ALPHA", "N1", d(4), 1)]
    empty_fo = spark.createDataFrame([], "symbol string, date date")
    return {
        "bhav_daily": frame,
        "ingest_log": spark.createDataFrame(log, "product string, date date, status string"),
        "index_daily": spark.createDataFrame(index, "index_name string, date date, close double"),
        "fo_daily": empty_fo,
        "deliverable_daily": spark.createDataFrame(
            deliv, "symbol string, series string, date date, delivery_quantity bigint"
        ),
        "equity_master": spark.createDataFrame([("ALPHA",), ("JUMP",), ("STILL",)], "symbol string"),
    }


@pytest.fixture(scope="module")
def built(tables):
    return report.build_report(tables, "cm", START, END, "now")


def test_coverage(built):
    assert rows_of(built.coverage, "month", "expected", "data_days", "holidays", "errors", "coverage_pct") == [
        ("2024-01", 21, 3, 2, 1, 14.29)
    ]


def test_month_without_log_rows_and_without_trading_days(spark, tables):
    log = tables["ingest_log"]
    got = coverage.month_coverage(log, ["cm", "fo"], dt.date(2024, 2, 3), dt.date(2024, 3, 1))
    assert rows_of(got, "product", "month", "expected", "data_days", "coverage_pct") == [
        ("cm", "2024-02", 19, 0, 0.0), ("cm", "2024-03", 1, 0, 0.0),
        ("fo", "2024-02", 19, 0, 0.0), ("fo", "2024-03", 1, 0, 0.0),
    ]
    weekend = coverage.month_coverage(log, ["cm"], dt.date(2024, 2, 3), dt.date(2024, 2, 4))
    assert weekend.first().coverage_pct == 100.0


def test_gaps(built):
    gaps = {}
    for r in built.gaps.collect():
        gaps.setdefault(r.gap_type, set()).add(r.date.day)
    assert gaps["ingest_error"] == {5}
    assert gaps["unknown_holiday"] == {31}
    assert 1 in gaps["missing_attempt"] and not gaps["missing_attempt"] & {2, 3, 4, 22, 26}


def test_anomalies(built):
    counts = {r.code: r["count"] for r in built.counts.collect()}
    assert counts == {
        "EXTREME_MOVE": 1, "ZERO_VOLUME_WITH_TRADES": 1, "NEGATIVE_PRICE": 1, "DELIVERY_MISMATCH": 1,
    }
    samples = {r.code: {p.name: p.value for p in r["sample"]} for r in built.samples.collect()}
    assert samples["EXTREME_MOVE"] == {
        "symbol": "JUMP", "date": "2024-01-03", "prev_close": "100.0", "close": "300.0"
    }
    assert samples["DELIVERY_MISMATCH"]["delivery_quantity"] == "800"


def test_drift(built, tables):
    assert rows_of(built.drift, "symbol") == [("MINUS",)]
    none = {**tables, "equity_master": tables["equity_master"].limit(0)}
    assert report.build_report(none, "cm", START, END).drift.count() == 0


def test_cross_tables(built):
    assert rows_of(built.cross, "table", "days", "rows") == [
        ("deliverable_daily", 1, 2), ("fo_daily", 0, 0), ("index_daily", 2, 2)
    ]


def test_gap_rows(built):
    rows = report.report_gap_rows(built)
    row = rows.where("gap_type = 'symbol_not_in_master'").first()
    assert row.date == END
    assert row.detail == "1 EQ symbols with bars missing from master (e.g. MINUS)"
    assert rows.where("gap_type = 'ingest_error'").first().detail == "ingest failed"


def test_markdown(built):
    lines = [r.line for r in report.report_lines(built).orderBy("section", "ord").collect()]
    assert lines[0] == "# data-quality report — cm"
    assert "| 2024-01 | 21 | 3 | 2 | 1 | 14.29% |" in lines
    assert " - 2024-01-05" in lines
    at = lines.index("### EXTREME_MOVE (1)")
    assert lines[at + 1 : at + 6] == [
        "", "| symbol | date | prev_close | close |", "| --- | --- | --- | --- |",
        "| JUMP | 2024-01-03 | 100.0 | 300.0 |", "",
    ]
    assert "EQ symbols with bars but missing from the master: MINUS" in lines
    assert "| fo_daily | 0 | 0 | - | - |" in lines


def test_json(built):
    text = "\n".join(r.line for r in report.report_json(built).orderBy("section", "ord").collect())
    doc = json.loads(text)
    assert (doc["product"], doc["start"], doc["end"]) == ("cm", "2024-01-01", "2024-01-31")
    assert doc["coverage"][0]["holidays_detected"] == 2
    assert doc["gaps"]["errors"] == ["2024-01-05"]
    assert [a["code"] for a in doc["anomalies"]][0] == "EXTREME_MOVE"
    assert doc["anomalies"][0]["samples"][0]["symbol"] == "JUMP"
    assert doc["master_drift"] == ["MINUS"]
    assert doc["cross_tables"][1]["first"] is None


def test_range(tables):
    log = tables["ingest_log"]
    assert report.report_range(log, "cm", month="2024-02") == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert report.report_range(log, "cm") == (dt.date(2024, 1, 2), dt.date(2024, 1, 31))
    today = dt.date(2024, 6, 1)
    assert report.report_range(log, "fo", today=today) == (dt.date(2023, 6, 1), today)
    assert report.report_range(log, "cm", end=END) == (dt.date(2000, 1, 1), END)
    with pytest.raises(ValueError, match="after end"):
        report.report_range(log, "cm", start=END, end=START)


def test_run_report_writes_and_refreshes(store, tables, tmp_path):
    store.write_ingest_log(tables["ingest_log"])
    done = report.run_report(store, "cm", str(tmp_path / "out"), month="2024-01")
    assert done["gap_rows"] == store["data_gaps"].count() > 0
    again = report.run_report(store, "cm", month="2024-01")
    assert again["gap_rows"] == done["gap_rows"] == store["data_gaps"].count()
    text = store.spark.read.text(done["json"])
    parts = sorted((tmp_path / "out" / "report_cm.json").glob("part-*"))
    assert json.loads("".join(p.read_text() for p in parts))["product"] == "cm"
    assert text.count() > 5
