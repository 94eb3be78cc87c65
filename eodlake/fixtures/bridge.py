"""Views that give the test tables the shape of day files.

The same text runs in Spark and in DuckDB; only three date expressions differ by dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.functions.text import col

SPARK = {
    "DMY": "upper(date_format(ts,'dd-MMM-yyyy'))",
    "DMYN": "date_format(ts,'dd-MM-yyyy')",
    "LOGD": "date_add(DATE '2024-01-01', cast(o_custkey % 29 + o_orderkey % 13 as int))",
}
DUCKDB = {
    "DMY": "upper(strftime(ts,'%d-%b-%Y'))",
    "DMYN": "strftime(ts,'%d-%m-%Y')",
    "LOGD": "cast(DATE '2024-01-01' + cast(o_custkey % 29 + o_orderkey % 13 as integer) as date)",
}

_EVENTS = """
with e as (select event_id, user_id, event_type, cast(ts as date) as d, {DMY} as dmy, {DMYN} as dmyn,
  cast((100 + 2 * (event_id * 7 % 25)) as decimal(18,2)) as pc,
  cast(cast((50 + event_id * 7 % 25) * (200 + (event_id % 121 - 60)) as decimal(18,0)) * cast('0.01' as decimal(3,2)) as decimal(18,2)) as cl,
  cast(event_id % 11 - 5 as decimal(18,2)) as od, cast(value as decimal(18,2)) as v from events),
p as (select *, cast(pc + od as decimal(18,2)) as op from e),
b as (select *, cast(case when event_id % 53 = 0 then least(op, cl) - 2 else greatest(op, cl) + 1 end as decimal(18,2)) as hi, cast(case when event_id % 307 = 0 then -1 else least(op, cl) - 1 end as decimal(18,2)) as lo from p)
"""

VIEWS = {
    "raw_cm": _EVENTS + """
select event_id as row_no, d as file_date,
  case when event_id % 211 = 0 then '   ' else ' u' || lpad(cast(user_id as string), 4, '0') end as symbol,
  case when event_type in ('view','click','purchase') then 'eq ' when event_type = 'signup' then 'BE' else 'N1' end as series,
  case when event_id % 97 = 0 then 'not-a-date' when event_id % 89 = 0 then '05-FEB-2024' else dmy end as date,
  cast(op as string) as open, cast(hi as string) as high, cast(lo as string) as low, cast(cl as string) as close, cast(pc as string) as prev_close,
  cast(v as string) as turnover_lacs, case when event_id % 71 = 0 then '-' else cast(event_id % 997 as string) end as total_traded_quantity,
  cast(event_id % 13 as string) as no_of_trades, case when event_id % 3 = 0 then null else cast(event_id % 997 * 4 as string) end as delivery_qty,
  cast(event_id % 101 as string) as delivery_pct from b""",
    "raw_idx": _EVENTS + """
select event_id as row_no, d as file_date, case when event_id % 211 = 0 then ' ' else 'Nifty ' || cast(user_id % 15 * 10 as string) end as index_name,
  case when event_id % 97 = 0 then '2024/01/01' else dmyn end as date, cast(op as string) as open, cast(hi as string) as high, cast(lo as string) as low, cast(cl as string) as close,
  case when event_id % 71 = 0 then '-' else cast(event_id * 3 as string) end as volume, cast(v as string) as turnover from b""",
    "raw_fo": _EVENTS + """
select event_id as row_no, d as file_date, case event_type when 'view' then 'FUTIDX' when 'click' then 'OPTIDX' when 'purchase' then 'FUTSTK' else 'OPTSTK' end as instrument,
  case when user_id % 10 = 0 then 'nifty' else 'U' || lpad(cast(user_id as string), 4, '0') end as symbol, case when event_id % 101 = 0 then null when event_id % 2 = 0 then '25-Jan-2024' else '29-Feb-2024' end as expiry_date,
  case when event_type in ('view','purchase') then case when event_id % 2 = 0 then '' else 'xx' end when event_id % 4 < 2 then 'CE' else 'pe ' end as option_type, cast(user_id % 5 * 100 as string) as strike_price,
  case when event_id % 83 = 0 then null when event_id % 89 = 0 then '05-FEB-2024' else dmy end as date,
  case when event_id % 4 = 0 then '0' else cast(op as string) end as open, cast(hi as string) as high, cast(lo as string) as low, cast(cl as string) as close, cast(cl as string) as settle_price,
  cast(event_id % 5003 as string) as contracts, cast(v as string) as val_inlakh, cast(event_id * 11 % 100003 as string) as open_interest, cast(event_id % 2001 - 1000 as string) as change_in_oi from b""",
    "raw_deliv": _EVENTS + """
select event_id as row_no, d as file_date, 'U' || lpad(cast(user_id as string), 4, '0') as symbol, case when event_id % 61 = 0 then ' ' when event_type in ('view','click','purchase') then ' EQ' else 'N1' end as series,
  case when event_id % 97 = 0 then 'bad' else dmy end as date, cast(event_id % 997 as string) as quantity_traded, case when event_id % 71 = 0 then '-' else cast(event_id % 997 * 4 as string) end as delivery_quantity,
  case when event_id % 71 = 0 then '-' else cast(cast(event_id % 101 as decimal(18,2)) as string) end as delivery_to_traded from b""",
    "raw_master": """
select c_custkey as row_no, case when c_custkey % 113 = 0 then ' ' else ' u' || lpad(cast(c_custkey - c_custkey % 5 + case when c_custkey % 5 = 4 then 1 else c_custkey % 5 end as string), 4, '0') end as symbol, upper(c_name) as name,
  case when c_custkey % 5 = 4 then 'BE' else 'eq' end as series, case c_custkey % 3 when 0 then '03-JAN-1994' when 1 then '1994-01-04' else '05-January-1994' end as listing_date, 'ine' || lpad(cast(c_custkey as string), 9, '0') as isin from customer where c_custkey % 5 <> 0""",
    "log_attempts": """
select o_orderkey as seq, o_orderstatus as batch, case substr(o_orderpriority,1,1) when '1' then 'cm' when '2' then 'idx' when '3' then 'fo' when '4' then 'deliv' else 'master' end as product, {LOGD} as date,
 case when o_orderstatus='P' and o_orderkey % 7 = 0 then 'error' when o_orderkey % 11 = 0 then 'not_a_trading_day' else 'ingested' end as status from orders""",
    "ingest_log": """
select product, date, status, row_no as seq from (select *, row_number() over (partition by product, date order by row_no desc) rn from (
 select o_orderkey as row_no, case substr(o_orderpriority,1,1) when '1' then 'cm' when '2' then 'idx' when '3' then 'fo' when '4' then 'deliv' else 'master' end as product, {LOGD} as date,
 case when o_orderstatus='P' and o_orderkey % 7 = 0 then 'error' when o_orderkey % 11 = 0 then 'not_a_trading_day' else 'ingested' end as status from orders) z) w where rn = 1""",
}

# view column -> header as the day files spell it
HEADERS = {
    "cm": {
        "symbol": "SYMBOL", "series": " SERIES", "date": "DATE", "prev_close": " PREV_CLOSE",
        "open": "OPEN_PRICE", "high": "HIGH_PRICE", "low": "LOW_PRICE", "close": "CLOSE_PRICE",
        "total_traded_quantity": "TTL_TRD_QNTY", "turnover_lacs": "TURNOVER_LACS",
        "no_of_trades": "NO_OF_TRADES", "delivery_qty": "DELIV_QTY", "delivery_pct": "DELIV_PER",
    },
    "idx": {
        "index_name": "Index Name", "date": "Index Date", "open": "Open Index Value",
        "high": "High Index Value", "low": "Low Index Value", "close": "Closing Index Value",
        "volume": "Volume", "turnover": "Turnover (Rs. Cr.)",
    },
    "fo": {
        "instrument": "INSTRUMENT", "symbol": "SYMBOL", "expiry_date": "EXPIRY_DT",
        "strike_price": "STRIKE_PR", "option_type": "OPTION_TYP", "open": "OPEN", "high": "HIGH",
        "low": "LOW", "close": "CLOSE", "settle_price": "SETTLE_PR", "contracts": "CONTRACTS",
        "val_inlakh": "VAL_INLAKH", "open_interest": "OPEN_INT", "change_in_oi": "CHG_IN_OI",
        "date": "TIMESTAMP",
    },
    "deliv": {
        "symbol": "SYMBOL", "series": " SERIES", "date": " DATE1",
        "quantity_traded": " TTL_TRD_QNTY", "delivery_quantity": " DELIV_QTY",
        "delivery_to_traded": " DELIV_PER",
    },
    "master": {
        "symbol": "SYMBOL", "name": "NAME OF COMPANY", "series": " SERIES",
        "listing_date": " DATE OF LISTING", "isin": " ISIN NUMBER",
    },
}

_SOURCE = {"raw_master": "customer", "ingest_log": "orders", "log_attempts": "orders"}


def sql(view: str, dialect: dict[str, str]) -> str:
    text = VIEWS[view]
    for name, expression in dialect.items():
        text = text.replace("{" + name + "}", expression)
    return text.strip()


def view(spark: SparkSession, sf_dir: str, name: str, ordered: bool = False) -> DataFrame:
    """A bridge view on the tables of one folder; `ordered` spreads events by range of (day, id) before any text is made of them."""
    source = _SOURCE.get(name, "events")
    frame = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    if ordered and source == "events":
        frame = frame.repartitionByRange(F.to_date("ts"), "event_id")
    text = sql(name, SPARK).replace(f"from {source}", "from {source}")
    return spark.sql(text, source=frame)


def raw(spark: SparkSession, sf_dir: str, product: str, ordered: bool = False) -> DataFrame:
    """A bridge view under file headers, as the scan of a folder of day files gives it."""
    frame = view(spark, sf_dir, f"raw_{product}", ordered)
    meta = ["row_no"] if product == "master" else ["file_date", "row_no"]
    return frame.select(
        *meta, *[F.col(c).alias(header) for c, header in HEADERS[product].items()]
    )


def normalized(raw_frame: DataFrame, product: str) -> DataFrame:
    """Back to the view's own column names (for text-level checks)."""
    meta = [c for c in ("file_date", "row_no") if c in raw_frame.columns]
    return raw_frame.select(*meta, *[col(h).alias(c) for c, h in HEADERS[product].items()])
