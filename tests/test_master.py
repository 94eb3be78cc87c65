"""The equity master: reading its parts, choosing one row per symbol, drift, and replacing the table as a whole."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import DAY, rows_of
from test_store import bars

from eodlake.operators import store as store_module
from eodlake.plans.ingest import refresh_master

HEADER = "SYMBOL,NAME OF COMPANY, SERIES, DATE OF LISTING, ISIN NUMBER"  # fixed format


def written(path, *rows):
    path.write_text("\n".join([HEADER, *rows]) + "\n")
    return str(path)


def test_parts_dates_and_quoted_breaks(store, tmp_path):
    """A folder of parts; months in full and short, absent dates, a name over two lines, no symbol."""
    folder = tmp_path / "master.csv"
    folder.mkdir()
    written(folder / "part-0.csv", 'quartz,"Quartz\nMinerals",EQ,7-September-2015,in9', ",Unnamed,EQ,7-SEP-2015,IN0")
    written(folder / "part-1.csv", "MICA,Mica Works,EQ,,IN8", "SLATE,Slate Works,BE,2019-11-30,IN7")
    done = refresh_master(store, str(folder), DAY)
    assert (done["rows"], done["drift_count"]) == (3, 0)
    assert rows_of(store["equity_master"], "symbol", "name", "series", "isin", "listing_date") == [
        ("MICA", "Mica Works", "EQ", "IN8", None),
        ("QUARTZ", "Quartz\nMinerals", "EQ", "IN9", dt.date(2015, 9, 7)),
        ("SLATE", "Slate Works", "BE", "IN7", dt.date(2019, 11, 30)),
    ]
    assert [r.num_rows for r in store["ingest_log"].collect()] == [3]


def test_earliest_equity_row_wins_and_file_order_breaks_ties(store, tmp_path):
    path = written(
        tmp_path / "m.csv", "FLINT,Trade,BT,01-FEB-1990,I1", "FLINT,Later,EQ,02-FEB-2001,I2", "FLINT,Sooner,EQ,01-FEB-2001,I3",
        "FLINT,Same day,EQ,01-FEB-2001,I4", "CHALK,Only trade,BT,01-FEB-1990,I5",
    )
    refresh_master(store, path, DAY)
    assert rows_of(store["equity_master"], "symbol", "name") == [("CHALK", "Only trade"), ("FLINT", "Sooner")]


def test_drift_lists_equity_bars_without_a_master_row(spark, store, tmp_path):
    store.upsert_bars(bars(spark, [("FLINT", 2.0, DAY), ("BASALT", 2.0, DAY), ("GNEISS", 2.0, DAY)]), "b.csv")
    traded = bars(spark, [("TUFF", 2.0, DAY)]).drop("series").selectExpr("*", "'BE' AS series")
    store.upsert_bars(traded, "b.csv")
    done = refresh_master(store, written(tmp_path / "m.csv", "FLINT,Flint,EQ,01-FEB-2001,I1"), DAY)
    assert sorted(r.symbol for r in done["drift"].collect()) == ["BASALT", "GNEISS"]


@pytest.mark.parametrize("content", [None, b"", b"\n \n", "SYMBOL,SERIES\nM\xe4,EQ\n".encode("latin-1")])
def test_what_cannot_be_read_is_an_error(store, tmp_path, content):
    path = tmp_path / "m.csv"
    if content is not None:
        path.write_bytes(content)
    with pytest.raises(ValueError, match="failed to read equity master"):
        refresh_master(store, str(path))


def test_a_failing_replacement_leaves_the_old_table(store, tmp_path, monkeypatch):
    refresh_master(store, written(tmp_path / "m.csv", "FLINT,Flint,EQ,01-FEB-2001,I1"), DAY)

    def fails(*_):
        raise OSError("lost")

    monkeypatch.setattr(store_module, "replace_folder", fails)
    with pytest.raises(OSError, match="lost"):
        refresh_master(store, written(tmp_path / "m.csv", "CHALK,Chalk,EQ,01-FEB-2001,I2"), DAY)
    assert rows_of(store["equity_master"], "symbol") == [("FLINT",)]
    # cut off between the two moves: the old folder is brought back
    folder = tmp_path / "store" / "equity_master"
    folder.rename(folder.with_name("equity_master.old"))
    store.create_tables()
    assert rows_of(store["equity_master"], "symbol") == [("FLINT",)]
