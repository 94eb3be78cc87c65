from __future__ import annotations

import datetime as dt

import pytest
from conftest import CM_CSV, CM_HEADER, CM_ROWS, DAY, DELIV_CSV, FO_CSV, IDX_CSV, rows_of

from eodlake.operators.clean import (
    clean_bars, clean_deliverable, clean_fo, clean_index, clean_layouts, file_status,
)
from eodlake.operators.layout import match_headers


def codes(cleaned):
    return sorted(r.code for r in cleaned.issues.collect())


def test_bars_types_and_case(raw):
    cleaned = clean_bars(raw(CM_CSV), DAY)
    assert codes(cleaned) == []
    assert rows_of(cleaned.rows, "symbol", "series", "date") == [
        ("HERON", "EQ", DAY), ("PLOVER", "EQ", DAY), ("TERN", "BE", DAY)
    ]
    assert dict(cleaned.rows.dtypes)["open"] == "double"
    assert dict(cleaned.rows.dtypes)["total_traded_quantity"] == "bigint"


def test_turnover_in_lakhs_becomes_rupees(raw):
    row = clean_bars(raw(CM_CSV), DAY).rows.where("symbol = 'HERON'").first()
    assert row.turnover == pytest.approx(76.2 * 100000)


def test_file_given_twice_keeps_first_rows(raw):
    twice = "\n".join([CM_HEADER, *CM_ROWS, *[r.replace(",EQ,", ",EQ,", 1) for r in CM_ROWS]])
    changed = twice.rsplit("\n", 3)[0] + "\n" + CM_ROWS[0].replace("820.30", "1.00")
    cleaned = clean_bars(raw(changed), DAY)
    assert cleaned.rows.count() == 3
    assert cleaned.rows.where("symbol = 'HERON'").first().close == 820.3
    issue = cleaned.issues_of("DUPLICATE_ROWS").first()
    assert issue.message == "dropped 1 duplicate rows"


def test_ohlc_violation_is_kept_and_flagged(raw):
    bad = "\n".join([CM_HEADER, CM_ROWS[0].replace("829.75", "90.00"), CM_ROWS[1]])
    cleaned = clean_bars(raw(bad), DAY)
    assert cleaned.rows.count() == 2
    assert [(r.code, r.symbol) for r in cleaned.issues.collect()] == [("OHLC_INVALID", "HERON")]


def test_null_price_is_no_ohlc_violation(raw):
    cleaned = clean_bars(raw("\n".join([CM_HEADER, CM_ROWS[0].replace("829.75", "-")])), DAY)
    assert codes(cleaned) == []
    assert cleaned.rows.first().high is None


def test_negative_previous_close_is_flagged(raw):
    cleaned = clean_bars(raw("\n".join([CM_HEADER, CM_ROWS[0].replace(",812.40,", ",-1,")])), DAY)
    assert codes(cleaned) == ["OHLC_INVALID"]


def test_duplicates_are_flagged_before_they_are_dropped(raw):
    bad = CM_ROWS[0].replace("829.75", "90.00")
    cleaned = clean_bars(raw("\n".join([CM_HEADER, bad, bad])), DAY)
    assert codes(cleaned) == ["DUPLICATE_ROWS", "OHLC_INVALID", "OHLC_INVALID"]


def test_bad_date_is_dropped_and_quoted(raw):
    cleaned = clean_bars(
        raw("\n".join([CM_HEADER, CM_ROWS[0].replace("13-MAR-2024", "soon"), CM_ROWS[1]])), DAY
    )
    assert rows_of(cleaned.rows, "symbol") == [("PLOVER",)]
    issue = cleaned.issues.first()
    assert (issue.symbol, issue.series, issue.code) == ("HERON", "EQ", "BAD_DATE")
    assert issue.message == "unparsable date 'soon'"


def test_wrong_day_is_flagged_and_kept(raw):
    cleaned = clean_bars(raw(CM_CSV), dt.date(2024, 3, 14))
    assert cleaned.rows.count() == 3
    assert codes(cleaned) == ["DATE_MISMATCH"] * 3


def test_no_expected_day_means_no_mismatch(raw):
    assert codes(clean_bars(raw(CM_CSV))) == []


def test_blank_symbol_is_an_issue_but_null_is_not(raw):
    blank = CM_ROWS[0].replace("HERON", "  ")
    null = CM_ROWS[0].replace("HERON", "")
    cleaned = clean_bars(raw("\n".join([CM_HEADER, blank, blank, null, CM_ROWS[1]])), DAY)
    assert rows_of(cleaned.rows, "symbol") == [("PLOVER",)]
    assert codes(cleaned) == ["EMPTY_SYMBOL"]  # one for the file


def test_current_layout(raw):
    text = (
        "SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,LAST,PREVCLOSE,TOTTRDQTY,TOTTRDVAL,TIMESTAMP,"
        "TOTALTRADES,ISIN,\nHERON,EQ,815,829,806,820,818,812,9315,7638300,13-MAR-2024,644,INE9,\n"
    )
    row = clean_bars(raw(text), DAY).rows.first()
    assert (row.close, row.turnover, row.delivery_qty, row.delivery_pct) == (820, 7638300, 0, 0.0)
    assert row.avg_price is None and row.prev_close == 812


def test_missing_required_column_raises(raw):
    with pytest.raises(ValueError, match="missing required columns"):
        clean_bars(raw("SYMBOL,SERIES\nA,EQ"))


def test_two_headers_for_one_column_raise():
    with pytest.raises(ValueError, match="both give 'close'"):
        match_headers("cm", ["SYMBOL", "SERIES", "DATE", "OPEN", "HIGH", "LOW", "CLOSE", "CLOSE_PRICE"])


def test_index(raw):
    cleaned = clean_index(raw(IDX_CSV), DAY)
    assert codes(cleaned) == []
    assert rows_of(cleaned.rows, "index_name", "date", "close", "volume") == [
        ("SEABIRD 100", DAY, 8177.65, 45012), ("WADERS 30", DAY, 1204.9, 0)
    ]


def test_index_ohlc(raw):
    assert codes(clean_index(raw(IDX_CSV.replace("8190,", "8000,")), DAY)) == ["OHLC_INVALID"]


def test_fo(raw):
    cleaned = clean_fo(raw(FO_CSV), DAY)
    assert codes(cleaned) == []  # zero prices are legal
    assert rows_of(cleaned.rows, "instrument", "symbol", "option_type", "strike_price", "value") == [
        ("FUTIDX", "SEABIRD", "XX", 0.0, 74175000.0),
        ("FUTSTK", "HERON", "XX", 0.0, 2975000.0),
        ("OPTIDX", "SEABIRD", "PE", 8200.0, 925000.0),
    ]


def test_fo_date_comes_from_the_file(raw):
    text = FO_CSV.replace("0,13-MAR-2024,", "0,,", 1)
    cleaned = clean_fo(raw(text), DAY)
    assert {r.date for r in cleaned.rows.collect()} == {DAY}
    assert codes(cleaned) == []


def test_fo_without_any_date_is_one_issue(raw):
    text = FO_CSV.replace(",13-MAR-2024,", ",,")
    cleaned = clean_fo(raw(text))
    assert cleaned.rows.count() == 0
    issue = cleaned.issues.first()
    assert (issue.code, issue.message) == ("BAD_DATE", "3 rows with unresolvable date")


def test_fo_mismatch_counts_rows_dropped_later(raw):
    text = FO_CSV.replace("28-Mar-2024", "", 1).replace("13-MAR-2024", "14-MAR-2024", 1)
    assert codes(clean_fo(raw(text), DAY)) == ["DATE_MISMATCH", "EXPIRY_MISSING"]


def test_fo_duplicates(raw):
    text = FO_CSV + FO_CSV.split("\n", 1)[1]
    cleaned = clean_fo(raw(text), DAY)
    assert cleaned.rows.count() == 3
    assert cleaned.issues.first().message == "dropped 3 duplicate FO rows"


def test_fo_needs_a_date_from_somewhere(raw):
    text = FO_CSV.replace(",TIMESTAMP,", ",OTHER,")
    with pytest.raises(ValueError, match="no TIMESTAMP"):
        clean_fo(raw(text))
    assert clean_fo(raw(text), DAY).rows.count() == 3


def test_deliverable(raw):
    cleaned = clean_deliverable(raw(DELIV_CSV), DAY)
    assert codes(cleaned) == []
    assert rows_of(cleaned.rows, "symbol", "series", "quantity_traded", "delivery_quantity",
                   "delivery_to_traded") == [
        ("HERON", "EQ", 9315, 5120, 54.97),
        ("HERON", "GB", 12, 12, 100.0),
        ("TERN", "BE", 640, 0, None),
    ]


def test_deliverable_without_series_is_eq(raw):
    text = "SYMBOL,DATE1,DELIV_QTY\nHERON,13-Mar-2024,5\n"
    row = clean_deliverable(raw(text), DAY).rows.first()
    assert (row.series, row.delivery_quantity, row.quantity_traded) == ("EQ", 5, 0)


def test_a_null_the_table_forbids_fails_the_file(raw):
    text = "\n".join([CM_HEADER, CM_ROWS[0].replace("54.97", "-"), CM_ROWS[1]])
    cleaned, failed = clean_layouts([clean_ready(raw(text), DAY)], "cm")
    row = file_status(cleaned, failed).first()
    assert (row.status, row.num_rows) == ("error", 0)


def test_one_bad_layout_leaves_the_others(raw):
    good = clean_ready(raw(CM_CSV), DAY)
    bad = clean_ready(raw("SYMBOL,SERIES\nA,EQ"), dt.date(2024, 3, 14))
    status = {r.file_date: (r.status, r.num_rows) for r in
              file_status(*clean_layouts([good, bad], "cm")).collect()}
    assert status == {DAY: ("ingested", 3), dt.date(2024, 3, 14): ("error", 0)}


def clean_ready(frame, day):
    from eodlake.operators.normalize import with_file_columns

    return with_file_columns(frame, day)
