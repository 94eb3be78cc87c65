"""DuckDB SQL for every registered query, built from the same bridge views.

`RELATIONS` holds named subqueries; `with_relations` prefixes a statement with those it uses.
"""

from __future__ import annotations

import re

from eodlake.fixtures import bridge
from eodlake.functions.calendar import holiday_dates

SPACES = r"E' \t\n\r'"


def _strip(c: str) -> str:
    return f"trim({c}, {SPACES})"


def _ident(c: str) -> str:
    return f"upper({_strip(c)})"


def _long(c: str) -> str:
    s = _strip(c)
    return f"case when regexp_full_match({s}, '[+-]?[0-9]+') then try_cast({s} as bigint) end"


def _double(c: str) -> str:
    s = _strip(c)
    number = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return f"case when regexp_full_match({s}, '{number}') then try_cast({s} as double) end"


def _date(c: str, fmt: str = "%d-%b-%Y") -> str:
    return f"cast(try_strptime({c}, '{fmt}') as date)"


def _blank_to(c: str, default: str) -> str:
    return f"coalesce(nullif({_ident(c)}, ''), '{default}')"


HOLIDAY_VALUES = ", ".join(f"(DATE '{d}')" for d in holiday_dates())

RANGE = ("2024-01-01", "2024-02-29")

RELATIONS: dict[str, str] = {
    **{name: bridge.sql(name, bridge.DUCKDB) for name in bridge.VIEWS},
    "hol": f"select * from (values {HOLIDAY_VALUES}) t(date)",
    "cm_typed": f"""
select file_date, row_no, date as date_text, {_ident('symbol')} as symbol, {_ident('series')} as series,
  {_date(_strip('date'))} as date, {_double('prev_close')} as prev_close, {_double('open')} as open,
  {_double('high')} as high, {_double('low')} as low, cast(null as double) as last, {_double('close')} as close,
  cast(null as double) as avg_price, coalesce({_long('total_traded_quantity')}, 0) as total_traded_quantity,
  ({_double('turnover_lacs')}) * 100000 as turnover, coalesce({_long('no_of_trades')}, 0) as no_of_trades,
  coalesce({_long('delivery_qty')}, 0) as delivery_qty, {_double('delivery_pct')} as delivery_pct from raw_cm""",
    "cm_usable": "select * exclude (date_text) from cm_typed where date is not null and symbol <> ''",
    "cm_rows": """
select * exclude (rn) from (select *, row_number() over (partition by file_date, symbol, series, date order by row_no) rn from cm_usable) where rn = 1""",
    "bars": """
select * exclude (rn, file_date, row_no) from (select *, row_number() over (partition by symbol, series, date order by file_date desc, row_no) rn from cm_usable) where rn = 1""",
    "idx_typed": f"""
select file_date, row_no, date as date_text, {_ident('index_name')} as index_name, {_date(_strip('date'), '%d-%m-%Y')} as date,
  {_double('open')} as open, {_double('high')} as high, {_double('low')} as low, {_double('close')} as close,
  coalesce({_long('volume')}, 0) as volume, coalesce({_double('turnover')}, 0) as turnover from raw_idx""",
    "idx_usable": "select * exclude (date_text) from idx_typed where date is not null and index_name <> ''",
    "idx_rows": """
select * exclude (rn) from (select *, row_number() over (partition by file_date, index_name, date order by row_no) rn from idx_usable) where rn = 1""",
    "indices": """
select * exclude (rn, file_date, row_no) from (select *, row_number() over (partition by index_name, date order by file_date desc, row_no) rn from idx_usable) where rn = 1""",
    "fo_typed": f"""
select file_date, row_no, date as date_text, {_ident('instrument')} as instrument, {_ident('symbol')} as symbol,
  {_date(_strip('expiry_date'))} as expiry_date, {_blank_to('option_type', 'XX')} as option_type,
  coalesce({_double('strike_price')}, 0) as strike_price, {_date(_strip('date'))} as date,
  {_double('open')} as open, {_double('high')} as high, {_double('low')} as low, {_double('close')} as close,
  {_double('settle_price')} as settle_price, coalesce({_long('contracts')}, 0) as contracts,
  coalesce({_double('val_inlakh')}, 0) * 100000 as value, coalesce({_long('open_interest')}, 0) as open_interest,
  coalesce({_long('change_in_oi')}, 0) as change_in_oi from raw_fo""",
    "fo_usable": """
select * exclude (date_text) replace (coalesce(date, file_date) as date) from fo_typed
where coalesce(date, file_date) is not null and expiry_date is not null and symbol <> ''""",
    "fo_rows": """
select * exclude (rn) from (select *, row_number() over (partition by file_date, instrument, symbol, expiry_date, option_type, strike_price, date order by row_no) rn from fo_usable) where rn = 1""",
    "futures": """
select * exclude (rn, file_date, row_no) from (select *, row_number() over (partition by instrument, symbol, expiry_date, option_type, strike_price, date order by file_date desc, row_no) rn from fo_usable) where rn = 1""",
    "deliv_typed": f"""
select file_date, row_no, date as date_text, {_ident('symbol')} as symbol, {_blank_to('series', 'EQ')} as series,
  {_date(_strip('date'))} as date, coalesce({_long('quantity_traded')}, 0) as quantity_traded,
  coalesce({_long('delivery_quantity')}, 0) as delivery_quantity, {_double('delivery_to_traded')} as delivery_to_traded from raw_deliv""",
    "deliv_usable": "select * exclude (date_text) from deliv_typed where date is not null and symbol <> ''",
    "deliv_rows": """
select * exclude (rn) from (select *, row_number() over (partition by file_date, symbol, series, date order by row_no) rn from deliv_usable) where rn = 1""",
    "deliverables": """
select * exclude (rn, file_date, row_no) from (select *, row_number() over (partition by symbol, series, date order by file_date desc, row_no) rn from deliv_usable) where rn = 1""",
    "master_typed": f"""
select row_no, {_ident('symbol')} as symbol, {_strip('name')} as name, {_ident('series')} as series, {_ident('isin')} as isin,
  coalesce({_date('listing_date')}, {_date('listing_date', '%d-%B-%Y')}, {_date('listing_date', '%Y-%m-%d')}) as listing_date from raw_master""",
    "master": """
select symbol, name, isin, series, listing_date from (select *, row_number() over (partition by symbol
  order by series <> 'EQ' nulls first, listing_date nulls first, row_no) rn from master_typed where symbol <> '') where rn = 1""",
    "last_bars": "select * from bars where date = (select max(date) from bars)",
    "last_futures": "select * from futures where date = (select max(date) from futures)",
    "range_bars": "select * from bars where date in (select date from days)",
    "days": f"select cast(unnest(generate_series(DATE '{RANGE[0]}', DATE '{RANGE[1]}', INTERVAL 1 DAY)) as date) as date",
    "products": "select unnest(['cm', 'idx', 'fo', 'deliv']) as product",
    "gaps": """
select * from (select product, date, case when status is null and date not in (select date from hol) then 'missing_attempt'
  when status = 'error' then 'ingest_error'
  when status = 'not_a_trading_day' and date not in (select date from hol) then 'unknown_holiday' end as gap_type
 from (select product, date from products, days where isodow(date) < 6) left join ingest_log using (product, date)) where gap_type is not null""",
    "month_cov": """
select product, month, expected, coalesce(data_days, 0) as data_days, coalesce(holidays, 0) as holidays, coalesce(errors, 0) as errors,
  case when expected > 0 then round(100.0 * coalesce(data_days, 0) / expected, 2) else 100.0 end as coverage_pct
from (select product, month, expected from products, (select strftime(date, '%Y-%m') as month,
   count(*) filter (isodow(date) < 6 and date not in (select date from hol)) as expected from days group by 1))
left join (select product, strftime(date, '%Y-%m') as month, count(*) filter (status in ('ingested', 'skipped')) as data_days,
   count(*) filter (status = 'not_a_trading_day') as holidays, count(*) filter (status = 'error') as errors
  from ingest_log where date in (select date from days) group by 1, 2) using (product, month)""",
    "drift": "select distinct symbol from bars where series = 'EQ' and symbol not in (select symbol from master)",
    "gap_table": """
select product, date, gap_type, case gap_type when 'missing_attempt' then 'no ingest record' when 'ingest_error' then 'ingest failed'
  else 'server reported non-trading day' end as detail from gaps
union all select product, (select max(date) from days), 'symbol_not_in_master', n || ' EQ symbols with bars missing from master (e.g. ' || preview || ')'
from products, (select count(*) as n from drift),
  (select string_agg(symbol, ', ' order by symbol) as preview from (select symbol from drift order by symbol limit 5)) where n > 0""",
    "cross_cov": """
select 'index_daily' as "table", count(distinct date) as days, count(*) as rows, min(date) as first, max(date) as last from indices where date in (select date from days)
union all select 'fo_daily', count(distinct date), count(*), min(date), max(date) from futures where date in (select date from days)
union all select 'deliverable_daily', count(distinct date), count(*), min(date), max(date) from deliverables where date in (select date from days)""",
}

_OHLC_BAD = """(high + 0.001 < greatest(open, low, close) or low - 0.001 > least(open, high, close){prev})"""


def _ohlc_bad(prev: bool) -> str:
    return _OHLC_BAD.format(prev=" or prev_close < 0" if prev else "")


def _bad_date(p: str, symbol: str, series: str = "null") -> str:
    return (
        f"select file_date, {symbol} as symbol, {series} as series, 'BAD_DATE' as code, "
        f"'unparsable date ' || coalesce('''' || date_text || '''', 'None') as message "
        f"from {p}_typed where date is null"
    )


def _empty(p: str, symbol: str, message: str, extra: str = "") -> str:
    return (
        f"select file_date, cast(null as varchar) as symbol, cast(null as varchar) as series, "
        f"'EMPTY_SYMBOL' as code, '{message}' as message from {p}_typed "
        f"where coalesce(date, {'file_date' if p == 'fo' else 'date'}) is not null "
        f"and {symbol} = ''{extra} group by file_date"
    )


def _mismatch(p: str, symbol: str, series: str = "null") -> str:
    source = "fo_typed" if p == "fo" else f"{p}_usable"
    return (
        f"select file_date, {symbol} as symbol, {series} as series, 'DATE_MISMATCH' as code, "
        f"'file date ' || cast(file_date as varchar) || ' but row date ' || cast(date as varchar) "
        f"as message from {source} where date <> file_date"
    )


def _ohlc(p: str, symbol: str) -> str:
    return (
        f"select file_date, {symbol} as symbol, null as series, 'OHLC_INVALID' as code, "
        f"'open=' || open::varchar || ' high=' || high::varchar || ' low=' || low::varchar || "
        f"' close=' || close::varchar || ' violates OHLC bounds' as message "
        f"from {p}_usable where {_ohlc_bad(p == 'cm')}"
    )


def _duplicates(p: str, words: str) -> str:
    return (
        f"select u.file_date, null as symbol, null as series, 'DUPLICATE_ROWS' as code, "
        f"'dropped ' || cast(u.n - r.n as varchar) || ' {words}' as message "
        f"from (select file_date, count(*) n from {p}_usable group by 1) u "
        f"join (select file_date, count(*) n from {p}_rows group by 1) r using (file_date) "
        f"where u.n > r.n"
    )


_EXPIRY = (
    "select file_date, symbol, null as series, 'EXPIRY_MISSING' as code, "
    "'row without expiry: instrument=' || instrument as message from fo_typed "
    "where coalesce(date, file_date) is not null and expiry_date is null"
)

CHECKS: dict[str, dict[str, str]] = {
    "cm": {
        "BAD_DATE": _bad_date("cm", "symbol", "series"),
        "EMPTY_SYMBOL": _empty("cm", "symbol", "empty symbol row"),
        "DATE_MISMATCH": _mismatch("cm", "symbol", "series"),
        "OHLC_INVALID": _ohlc("cm", "symbol"),
        "DUPLICATE_ROWS": _duplicates("cm", "duplicate rows"),
    },
    "idx": {
        "BAD_DATE": _bad_date("idx", "index_name"),
        "EMPTY_SYMBOL": _empty("idx", "index_name", "empty index name"),
        "DATE_MISMATCH": _mismatch("idx", "index_name"),
        "OHLC_INVALID": _ohlc("idx", "index_name"),
        "DUPLICATE_ROWS": _duplicates("idx", "duplicate index rows"),
    },
    "fo": {
        "EMPTY_SYMBOL": _empty("fo", "symbol", "empty symbol row", " and expiry_date is not null"),
        "DATE_MISMATCH": _mismatch("fo", "symbol"),
        "EXPIRY_MISSING": _EXPIRY,
        "DUPLICATE_ROWS": _duplicates("fo", "duplicate FO rows"),
    },
    "deliv": {
        "BAD_DATE": _bad_date("deliv", "symbol"),
        "EMPTY_SYMBOL": _empty("deliv", "symbol", "empty symbol row"),
        "DATE_MISMATCH": _mismatch("deliv", "symbol"),
        "DUPLICATE_ROWS": _duplicates("deliv", "duplicate deliverable rows"),
    },
}


def issues_of(code: str) -> str:
    """One code over all products that check it."""
    return " union all ".join(
        f"select '{p}' as product, * from ({checks[code]})"
        for p, checks in CHECKS.items()
        if code in checks
    )


for _p, _checks in CHECKS.items():
    RELATIONS[f"{_p}_issues"] = " union all ".join(f"select * from ({q})" for q in _checks.values())


def with_relations(body: str) -> str:
    """Prefix `body` with the relations it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in RELATIONS:
            if re.search(rf"(?:\b(?:from|join)\s+|, ){name}\b", text) and name not in needed:
                visit(RELATIONS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    if body.startswith("with "):
        body = "select * from (" + body + ")"
    return "with " + ",\n".join(f"{n} as ({RELATIONS[n].strip()})" for n in needed) + "\n" + body
