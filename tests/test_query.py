from __future__ import annotations

import datetime as dt

import pytest
from conftest import DAY, rows_of
from test_store import bars

from eodlake.plans.export import export_rows, export_table
from eodlake.plans.sql import run_sql
from eodlake.plans.templates import TEMPLATES, execute_template

NEXT = dt.date(2024, 3, 14)


@pytest.fixture
def loaded(spark, store):
    rows = bars(spark, [("A", 1.0, DAY), ("B", 2.0, DAY), ("A", 3.0, NEXT)])
    store.upsert_bars(rows.selectExpr("*", "1.0D AS prev_close"), "x.csv")
    return store


def test_templates(loaded):
    assert rows_of(execute_template(loaded, "top_gainers"), "symbol", "date", "pct") == [("A", NEXT, 200.0)]
    counts = dict(rows_of(execute_template(loaded, "table_counts"), "table", "rows"))
    assert counts["bhav_daily"] == 3 and counts["equity_master"] == 0
    assert rows_of(execute_template(loaded, "latest"), "last_trading_day", "rows") == [(NEXT, 3)]
    assert execute_template(loaded, "nope") is None


def test_every_template_runs_on_empty_tables(store):
    for name in TEMPLATES:
        assert execute_template(store, name).count() in (0, 1, 5)


def test_run_sql(loaded):
    loaded.register_views()
    query = "SELECT symbol, close FROM bhav_daily WHERE date = '2024-03-13' ORDER BY close DESC; "
    assert [tuple(r) for r in run_sql(loaded.spark, query).collect()] == [("B", 2.0), ("A", 1.0)]
    assert run_sql(loaded.spark, "WITH a AS (SELECT 1 AS x) SELECT x FROM a -- done").first().x == 1


@pytest.mark.parametrize(
    "text",
    ["CREATE TABLE t (x INT)", "DROP TABLE bhav_daily", "SET x = 1", "INSERT INTO t VALUES (1)",
     "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "SELECT 1; DROP TABLE t", "",
     "SELECT 1) UNION ALL (SELECT 2; DROP TABLE t", "EXPLAIN SELECT 1", "CACHE TABLE bhav_daily"],
)
def test_run_sql_takes_queries_only(spark, text):
    with pytest.raises(ValueError):
        run_sql(spark, text)


def test_export(loaded, tmp_path):
    out = str(tmp_path / "out")
    export_table(loaded, "bhav_daily", out, symbols=["A"], start=NEXT, end=NEXT)
    assert rows_of(loaded.spark.read.parquet(out), "symbol", "close") == [("A", 3.0)]
    csv = str(tmp_path / "csv")
    export_table(loaded, "bhav_daily", csv, fmt="csv", series="EQ", single_file=True)
    (part,) = (tmp_path / "csv").glob("*.csv")
    lines = part.read_text().strip().splitlines()
    assert lines[0].startswith("symbol,series,date") and len(lines) == 4
    assert [line.split(",")[0] for line in lines[1:]] == ["A", "A", "B"]


def test_export_errors(loaded, tmp_path):
    with pytest.raises(ValueError, match="unknown export table"):
        export_rows(loaded, "nope")
    with pytest.raises(ValueError, match="format must be"):
        export_table(loaded, "bhav_daily", str(tmp_path / "x"), fmt="json")


def test_export_series_and_dates_skip_tables_without_them(loaded):
    loaded.upsert("equity_master", loaded.spark.createDataFrame([("A",)], "symbol string"))
    assert export_rows(loaded, "equity_master", symbols=["Z"], series="BE", start=NEXT).count() == 1
