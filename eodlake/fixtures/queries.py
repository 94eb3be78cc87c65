"""Registered queries: every operator over the bridge views of one test folder.

Each entry pairs a callable (spark, sf_dir) -> DataFrame with the DuckDB SQL of its result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.fixtures import bridge, landing, oracle
from eodlake.functions import calendar, text
from eodlake.model import DAILY_PRODUCTS, PRODUCTS, TABLES
from eodlake.operators import anomalies, clean, coverage, dedupe, layout, normalize, qc, store
from eodlake.plans import export, ingest, report, sql, templates
from eodlake.sources import files, master, scan
from eodlake.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

START, END = (dt.date.fromisoformat(d) for d in oracle.RANGE)


def query(name: str, expected: str | None = None):
    """Register a callable with the SQL of its result."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if expected is not None:
            ORACLES[name] = oracle.with_relations(expected.strip())
        return fn

    return register


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def typed(spark: SparkSession, sf: str, product: str) -> DataFrame:
    return normalize.typed(bridge.raw(spark, sf, product), product)


def cleaned(spark: SparkSession, sf: str, product: str) -> clean.Cleaned:
    return clean.clean(bridge.raw(spark, sf, product), product)


def per_product(spark, sf, products, columns) -> DataFrame:
    """The same projection of several typed frames, tagged by product."""
    return union(
        [typed(spark, sf, p).select(F.lit(p).alias("product"), *columns(p)) for p in products]
    )


class Tables(dict):
    """Table name -> state after loading all files of the bridge views; built on first use."""

    def __init__(self, spark: SparkSession, sf: str):
        super().__init__()
        self.spark, self.sf = spark, sf

    def __missing__(self, name: str) -> DataFrame:
        spark, sf = self.spark, self.sf
        if name == "equity_master":
            df = clean.clean_master(bridge.raw(spark, sf, "master"))
        elif name == "ingest_log":
            df = bridge.view(spark, sf, "ingest_log")
        else:
            product = next(p for p in DAILY_PRODUCTS if PRODUCTS[p].table == name)
            c = cleaned(spark, sf, product)
            df = store.last_writer(c.usable, name).select(*c.columns)
        self[name] = df
        return df


# ---- projections ----------------------------------------------------------------------------

@query(
    "norm_headers",
    """select file_date, row_no, symbol, series, date, prev_close, open, high, low, close,
    total_traded_quantity, turnover_lacs as turnover, no_of_trades, delivery_qty, delivery_pct
    from raw_cm""",
)
def norm_headers(spark, sf):
    return layout.normalize_headers(bridge.raw(spark, sf, "cm"), "cm")


FAULTY_DAY = dt.date(2024, 1, 16)


@query(
    "required_columns",
    """select file_date, case when file_date = DATE '2024-01-16' then 'error' else 'ingested' end as status,
    case when file_date = DATE '2024-01-16' then 0 else n end as num_rows
    from (select f.file_date, coalesce(n, 0) as n from (select distinct file_date from raw_cm) f
      left join (select file_date, count(*) as n from cm_rows group by 1) r using (file_date))""",
)
def required_columns(spark, sf):
    raw = bridge.raw(spark, sf, "cm")
    whole = raw.where(F.col("file_date") != F.lit(FAULTY_DAY))
    faulty = raw.where(F.col("file_date") == F.lit(FAULTY_DAY)).drop("CLOSE_PRICE")
    return clean.file_status(*clean.clean_layouts([whole, faulty], "cm")).drop("error")


@query(
    "not_null_gate",
    """select file_date, case when broken then 'error' else 'ingested' end as status,
    case when broken then 0 else n end as num_rows
    from (select file_date, count(*) as n,
      bool_or(file_date = DATE '2024-01-15' and delivery_pct = 0) as broken from cm_rows group by 1)""",
)
def not_null_gate(spark, sf):
    raw = bridge.raw(spark, sf, "cm")
    unreadable = (F.col("file_date") == F.lit(dt.date(2024, 1, 15))) & (F.col("DELIV_PER") == "0")
    raw = raw.withColumn("DELIV_PER", F.when(unreadable, "-").otherwise(F.col("DELIV_PER")))
    return clean.file_status(*clean.clean_layouts([raw], "cm")).drop("error")


@query(
    "norm_identifiers",
    """select 'cm' as product, row_no, symbol, series from cm_typed
    union all select 'idx', row_no, index_name, null from idx_typed
    union all select 'fo', row_no, symbol, instrument from fo_typed
    union all select 'deliv', row_no, symbol, series from deliv_typed
    union all select 'master', row_no, symbol, isin from master_typed""",
)
def norm_identifiers(spark, sf):
    second = {
        "cm": F.col("series"), "idx": F.lit(None).cast("string"), "fo": F.col("instrument"),
        "deliv": F.col("series"), "master": F.col("isin"),
    }
    return per_product(
        spark, sf, second,
        lambda p: [
            "row_no", F.col(qc.identifier_column(p)).alias("symbol"), second[p].alias("series")
        ],
    )


@query(
    "lenient_cast",
    f"""select 'cm' as product, row_no, {oracle._long('total_traded_quantity')} as whole,
      {oracle._double('close')} as number from raw_cm
    union all select 'deliv', row_no, {oracle._long('delivery_quantity')},
      {oracle._double('delivery_to_traded')} from raw_deliv
    union all select 'idx', row_no, {oracle._long('volume')}, {oracle._double('date')} from raw_idx""",
)
def lenient_cast(spark, sf):
    columns = {
        "cm": ("total_traded_quantity", "close"),
        "deliv": ("delivery_quantity", "delivery_to_traded"),
        "idx": ("volume", "date"),
    }
    return union(
        [
            layout.normalize_headers(bridge.raw(spark, sf, p), p).select(
                F.lit(p).alias("product"), "row_no",
                text.to_long(F.col(whole)).alias("whole"),
                text.to_double(F.col(number)).alias("number"),
            )
            for p, (whole, number) in columns.items()
        ]
    )


@query(
    "fill_zero",
    """select 'cm' as product, row_no, total_traded_quantity as quantity, delivery_qty as other from cm_typed
    union all select 'idx', row_no, volume, cast(turnover * 100 as bigint) from idx_typed
    union all select 'fo', row_no, contracts, open_interest from fo_typed
    union all select 'deliv', row_no, quantity_traded, delivery_quantity from deliv_typed""",
)
def fill_zero(spark, sf):
    columns = {
        "cm": (F.col("total_traded_quantity"), F.col("delivery_qty")),
        "idx": (F.col("volume"), F.round(F.col("turnover") * 100).cast("bigint")),
        "fo": (F.col("contracts"), F.col("open_interest")),
        "deliv": (F.col("quantity_traded"), F.col("delivery_quantity")),
    }
    return per_product(
        spark, sf, columns,
        lambda p: ["row_no", columns[p][0].alias("quantity"), columns[p][1].alias("other")],
    )


@query(
    "fill_defaults",
    """select row_no, cast(null as double) as prev_close, cast(null as double) as avg_price,
    cast(0 as bigint) as total_traded_quantity, cast(0 as bigint) as no_of_trades,
    cast(0 as bigint) as delivery_qty, cast(0.0 as double) as delivery_pct, turnover, close from cm_typed""",
)
def fill_defaults(spark, sf):
    absent = [" PREV_CLOSE", "TTL_TRD_QNTY", "NO_OF_TRADES", "DELIV_QTY", "DELIV_PER"]
    raw = bridge.raw(spark, sf, "cm")
    raw = raw.select(*[text.col(c) for c in raw.columns if c not in absent])
    return normalize.typed(raw, "cm").select(
        "row_no", "prev_close", "avg_price", "total_traded_quantity", "no_of_trades",
        "delivery_qty", "delivery_pct", "turnover", "close",
    )


@query(
    "scale_lakhs",
    f"""select 'TURNOVER_LACS' as header, row_no, turnover as rupees from cm_typed
    union all select 'TOTTRDVAL', row_no, {oracle._double('turnover_lacs')} from raw_cm
    union all select 'VAL_INLAKH', row_no, value from fo_typed""",
)
def scale_lakhs(spark, sf):
    raw = bridge.raw(spark, sf, "cm")
    return union(
        [
            normalize.typed(frame, p).select(
                F.lit(header).alias("header"), "row_no", F.col(c).alias("rupees")
            )
            for header, frame, p, c in (
                ("TURNOVER_LACS", raw, "cm", "turnover"),
                ("TOTTRDVAL", raw.withColumnRenamed("TURNOVER_LACS", "TOTTRDVAL"), "cm", "turnover"),
                ("VAL_INLAKH", bridge.raw(spark, sf, "fo"), "fo", "value"),
            )
        ]
    )


@query(
    "parse_trade_date",
    " union all ".join(
        f"select '{p}' as product, row_no, date_text, date from {p}_typed" for p in DAILY_PRODUCTS
    ),
)
def parse_trade_date(spark, sf):
    return per_product(spark, sf, DAILY_PRODUCTS, lambda p: ["row_no", "date_text", "date"])


@query("parse_listing_date", "select row_no, listing_date from master_typed")
def parse_listing_date(spark, sf):
    return typed(spark, sf, "master").select("row_no", "listing_date")


@query("norm_option_type", "select row_no, option_type from fo_typed")
def norm_option_type(spark, sf):
    return typed(spark, sf, "fo").select("row_no", "option_type")


@query("default_series", "select row_no, series from deliv_typed")
def default_series(spark, sf):
    return typed(spark, sf, "deliv").select("row_no", "series")


@query("fo_fill_date", "select row_no, coalesce(date, file_date) as date from fo_typed")
def fo_fill_date(spark, sf):
    return typed(spark, sf, "fo").select("row_no", qc.resolved_date("fo").alias("date"))


# ---- filters --------------------------------------------------------------------------------

@query(
    "drop_bad_date",
    """select 'cm' as product, row_no from cm_typed where date is not null
    union all select 'idx', row_no from idx_typed where date is not null
    union all select 'fo', row_no from fo_typed where coalesce(date, file_date) is not null
    union all select 'deliv', row_no from deliv_typed where date is not null""",
)
def drop_bad_date(spark, sf):
    return union(
        [
            typed(spark, sf, p).where(qc.dated(p)).select(F.lit(p).alias("product"), "row_no")
            for p in DAILY_PRODUCTS
        ]
    )


@query(
    "drop_empty_symbol",
    """select 'cm' as product, row_no, symbol from cm_typed where symbol <> ''
    union all select 'idx', row_no, index_name from idx_typed where index_name <> ''
    union all select 'fo', row_no, symbol from fo_typed where symbol <> ''
    union all select 'deliv', row_no, symbol from deliv_typed where symbol <> ''
    union all select 'master', row_no, symbol from master_typed where symbol <> ''""",
)
def drop_empty_symbol(spark, sf):
    return union(
        [
            typed(spark, sf, p).where(qc.named(p)).select(
                F.lit(p).alias("product"), "row_no", F.col(qc.identifier_column(p)).alias("symbol")
            )
            for p in (*DAILY_PRODUCTS, "master")
        ]
    )


@query("drop_no_expiry", "select row_no, expiry_date from fo_typed where expiry_date is not null")
def drop_no_expiry(spark, sf):
    return typed(spark, sf, "fo").where(qc.expires("fo")).select("row_no", "expiry_date")


@query("latest_day_rows", "select * from bars where date = (select max(date) from bars)")
def latest_day_rows(spark, sf):
    return templates.latest_day(Tables(spark, sf)["bhav_daily"])


# ---- quality checks -------------------------------------------------------------------------

def _register_check(key: str, code: str) -> None:
    products = [p for p, checks in oracle.CHECKS.items() if code in checks]

    @query(key, oracle.issues_of(code))
    def check(spark, sf):
        return union(
            [
                cleaned(spark, sf, p).issues_of(code)
                .select(F.lit(p).alias("product"), *qc.ISSUE_COLUMNS)
                for p in products
            ]
        )


for _key, _code in (
    ("qc_bad_date", "BAD_DATE"),
    ("qc_empty_symbol", "EMPTY_SYMBOL"),
    ("qc_date_mismatch", "DATE_MISMATCH"),
    ("qc_ohlc", "OHLC_INVALID"),
    ("qc_duplicates", "DUPLICATE_ROWS"),
    ("qc_expiry_missing", "EXPIRY_MISSING"),
):
    _register_check(_key, _code)


# ---- cleaners and deduplication -------------------------------------------------------------

def _register_cleaner(key: str, dedupe_key: str, p: str) -> None:
    table_key = ", ".join(PRODUCTS[p].key)

    @query(key, f"select * from {p}_rows")
    def rows(spark, sf):
        return cleaned(spark, sf, p).rows

    @query(
        dedupe_key,
        f"""select file_date, {table_key}, min(row_no) as row_no, count(*) as n_copies
        from {p}_usable group by file_date, {table_key}""",
    )
    def first(spark, sf):
        key = ["file_date", *PRODUCTS[p].key]
        c = cleaned(spark, sf, p)
        counts = c.copies.select(*key, "n_copies")
        return dedupe.keep_first(c.usable, key).select(*key, "row_no").join(counts, key)


for _key, _dedupe_key, _p in (
    ("clean_bars", "dedupe_first_cm", "cm"),
    ("clean_index", "dedupe_first_idx", "idx"),
    ("clean_fo", "dedupe_first_fo", "fo"),
    ("clean_deliverable", "dedupe_first_deliv", "deliv"),
):
    _register_cleaner(_key, _dedupe_key, _p)


@query("clean_master", "select * from master")
def clean_master(spark, sf):
    return clean.clean_master(bridge.raw(spark, sf, "master"))


@query("master_prefer_eq", "select symbol, series, listing_date from master")
def master_prefer_eq(spark, sf):
    rows = typed(spark, sf, "master").where(qc.named("master"))
    return dedupe.prefer_equity(rows).select("symbol", "series", "listing_date")


# ---- named queries --------------------------------------------------------------------------

_MOVERS_SQL = """select symbol, date, close, prev_close, round((close / prev_close - 1) * 100, 2) as pct
  from last_bars where series = 'EQ' and prev_close > 0"""
_TEMPLATE_SQL = {
    "latest": "select max(date) as last_trading_day, count(*) as rows from bars",
    "table_counts": " union all ".join(
        f"select '{table}' as \"table\", count(*) as rows from {relation}"
        for table, relation in (
            ("bhav_daily", "bars"), ("index_daily", "indices"), ("fo_daily", "futures"),
            ("deliverable_daily", "deliverables"), ("equity_master", "master"),
        )
    ),
    "top_gainers": _MOVERS_SQL + " order by close / prev_close desc nulls last, symbol limit 10",
    "top_losers": _MOVERS_SQL + " order by close / prev_close nulls last, symbol limit 10",
    "volume_leaders": """select symbol, date, total_traded_quantity as qty, round(turnover, 2) as turnover
      from last_bars order by qty desc, symbol, series limit 10""",
    "delivery_spike": """select symbol, date, delivery_qty, total_traded_quantity, round(delivery_pct, 2) as delivery_pct
      from (select * from last_bars where delivery_pct > 70 and total_traded_quantity > 0
        order by delivery_pct desc, symbol, series limit 10)""",
    "fo_most_traded": """select instrument, symbol, expiry_date, option_type, strike_price, contracts, round(value, 0) as value
      from last_futures order by contracts desc, instrument, symbol, expiry_date, option_type, strike_price limit 10""",
    "fo_open_interest": """select instrument, symbol, date, open_interest from futures
      where option_type = 'XX' and symbol = 'NIFTY' order by date, expiry_date, instrument, strike_price limit 20""",
    "index_history": """select index_name, date, close from indices
      where index_name = 'NIFTY 50' order by date limit 30""",
    "delivery_ratio": """select symbol, date, delivery_qty, delivery_quantity
      from (select * from bars where delivery_qty > 0) b join deliverables d using (symbol, date)
      order by date, symbol, b.series, d.series limit 10""",
}


def _register_template(name: str) -> None:
    @query(f"t_{name}", _TEMPLATE_SQL[name])
    def run(spark, sf):
        return templates.execute_template(Tables(spark, sf), name)


for _name in templates.TEMPLATES:
    _register_template(_name)


@query("execute_template", _TEMPLATE_SQL["top_gainers"])
def execute_template(spark, sf):
    return templates.execute_template(Tables(spark, sf), "top_gainers")


# ---- anomalies and drift --------------------------------------------------------------------

_ANOMALY_SQL = {
    "EXTREME_MOVE": """select series, symbol, date, prev_close, close from range_bars
      where series = 'EQ' and prev_close > 0 and abs(close / prev_close - 1) > 0.25""",
    "ZERO_VOLUME_WITH_TRADES": """select series, symbol, date, total_traded_quantity, no_of_trades from range_bars
      where no_of_trades > 0 and total_traded_quantity <= 0""",
    "NEGATIVE_PRICE": """select series, symbol, date, open, high, low, close from range_bars
      where least(open, high, low, close) < 0""",
    "DELIVERY_MISMATCH": """select b.series, symbol, date, delivery_qty, delivery_quantity
      from (select * from range_bars where delivery_qty > 0) b
      join (select * from deliverables where series = 'EQ') d using (symbol, date)
      where delivery_qty <> delivery_quantity""",
}


def _anomaly_sql(code: str) -> str:
    return f"select * exclude (series) from ({_ANOMALY_SQL[code]})"




@query("anomaly_extreme_move", _anomaly_sql("EXTREME_MOVE"))
def anomaly_extreme_move(spark, sf):
    return anomalies.extreme_moves(Tables(spark, sf)["bhav_daily"], START, END)


@query("anomaly_zero_volume", _anomaly_sql("ZERO_VOLUME_WITH_TRADES"))
def anomaly_zero_volume(spark, sf):
    return anomalies.zero_volumes(Tables(spark, sf)["bhav_daily"], START, END)


@query("anomaly_negative_price", _anomaly_sql("NEGATIVE_PRICE"))
def anomaly_negative_price(spark, sf):
    return anomalies.negative_prices(Tables(spark, sf)["bhav_daily"], START, END)


@query("anomaly_delivery_mismatch", _anomaly_sql("DELIVERY_MISMATCH"))
def anomaly_delivery_mismatch(spark, sf):
    tables = Tables(spark, sf)
    return anomalies.delivery_mismatches(
        tables["bhav_daily"], tables["deliverable_daily"], START, END
    ).drop("series")


@query(
    "anomaly_counts",
    " union all ".join(
        f"select {i} as code_no, '{code}' as code, count(*) as count from ({_ANOMALY_SQL[code]})"
        for i, code in enumerate(anomalies.CODES, 1)
    ),
)
def anomaly_counts(spark, sf):
    return anomalies.anomaly_counts(anomalies.anomalies(Tables(spark, sf), START, END))


def _sample_sql(code: str) -> str:
    columns = {
        "EXTREME_MOVE": ("prev_close", "close"),
        "ZERO_VOLUME_WITH_TRADES": ("total_traded_quantity", "no_of_trades"),
        "NEGATIVE_PRICE": ("open", "high", "low", "close"),
        "DELIVERY_MISMATCH": ("delivery_qty", "delivery_quantity"),
    }[code]
    pairs = " || ', ' || ".join(
        f"'{c}=' || coalesce(cast({c} as varchar), 'None')" for c in ("symbol", "date", *columns)
    )
    return (
        f"select '{code}' as code, ord, {pairs} as sample from (select *, "
        f"row_number() over (order by date, symbol, series) as ord from ({_ANOMALY_SQL[code]})) where ord <= 5"
    )


@query("anomaly_samples", " union all ".join(_sample_sql(c) for c in anomalies.CODES))
def anomaly_samples(spark, sf):
    found = anomalies.anomalies(Tables(spark, sf), START, END)
    pairs = F.transform("sample", lambda x: F.concat(x["name"], F.lit("="), x["value"]))
    return anomalies.anomaly_samples(found).select(
        "code", "ord", F.array_join(pairs, ", ").alias("sample")
    )


@query("master_drift", "select symbol from drift")
def master_drift(spark, sf):
    tables = Tables(spark, sf)
    return anomalies.master_drift(tables["bhav_daily"], tables["equity_master"])


# ---- files ----------------------------------------------------------------------------------

def _land(raw: DataFrame, product: str, root: str) -> None:
    """F&O as archives, the others as plain files; rows come in ranges of (day, number)."""
    (landing.write_archives if product == "fo" else landing.write_landing)(raw, product, root, ordered=True)


def _landed(spark, raws: dict[str, DataFrame], root: str) -> str:
    """Files of several products, written at the same time."""
    ingest.side_by_side(spark, [lambda p=p, raw=raw: _land(raw, p, root) for p, raw in raws.items()])
    return root


def _landing(spark, sf, products=DAILY_PRODUCTS) -> str:
    return _landed(spark, {p: bridge.raw(spark, sf, p, ordered=True) for p in products}, landing.fresh_folder(spark))


def _parts(spark, root, products=DAILY_PRODUCTS) -> DataFrame:
    listed = files.list_files(spark, [f"{root}/{p}" for p in products])
    return files.resolve_files(listed)


def _kept(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    folder = landing.fresh_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _scanned(spark, sf, products=DAILY_PRODUCTS) -> tuple[DataFrame, list[tuple[str, DataFrame]]]:
    """Inspected parts of landed files, and the raw frames that a scan gives, by product."""
    # both are kept: each use would hash and scan all files again, and unpacking again would give other file names
    inspected = _kept(scan.inspect(spark, _parts(spark, _landing(spark, sf, products), products)))
    data = _kept(scan.unpacked(inspected, landing.fresh_folder(spark)))
    frames = [
        (p, frame)
        for p in products
        for frame in scan.scan_raw(spark, p, scan.group_by_layout(data.where(F.col("product") == p)))
    ]
    return inspected, frames


_RAW_COLUMNS = {
    "cm": ("symbol", "date", "close", "delivery_qty"),
    "idx": ("index_name", "date", "close", "volume"),
    "deliv": ("symbol", "date", "quantity_traded", "delivery_to_traded"),
    "fo": ("symbol", "date", "close", "contracts"),
}


@query(
    "scan_raw",
    " union all ".join(
        f"select '{p}' as product, file_date, {a} as name, {b} as date, {c} as first, {d} as second from raw_{p}"
        for p, (a, b, c, d) in _RAW_COLUMNS.items()
    ),
)
def scan_raw(spark, sf):
    return union(
        [
            layout.normalize_headers(frame, p).select(
                F.lit(p).alias("product"), "file_date",
                *[F.col(c).alias(n) for c, n in zip(_RAW_COLUMNS[p], ("name", "date", "first", "second"))],
            )
            for p, frame in _scanned(spark, sf)[1]
        ]
    )


@query(
    "zip_member",
    """select file_date, instrument, symbol, expiry_date, nullif(option_type, '') as option_type,
    strike_price, date, close, contracts, val_inlakh as value from raw_fo""",
)
def zip_member(spark, sf):
    frames = [layout.normalize_headers(frame, "fo") for _, frame in _scanned(spark, sf, ("fo",))[1]]
    return union(
        [
            frame.select(
                "file_date", "instrument", "symbol", "expiry_date", "option_type", "strike_price", "date",
                "close", "contracts", "value",
            )
            for frame in frames
        ]
    )


@query(
    "resolve_files",
    """with d as (select distinct file_date as date, strftime(file_date, '%d') as dd, upper(strftime(file_date, '%b')) as mon,
      strftime(file_date, '%m') as mm, strftime(file_date, '%Y') as yyyy from raw_cm)
    select 'cm' as product, date, 'cm' || dd || mon || yyyy || 'bhav.csv' as name, false as zipped from d
    union all select 'fo', date, 'fo' || dd || mon || yyyy || 'bhav.csv.zip', true from d
    union all select 'idx', date, 'ind_close_all_' || dd || mm || yyyy || '.csv', false from d
    union all select 'deliv', date, 'sec_bhavdata_full_' || dd || mm || yyyy || '.csv', false from d""",
)
def resolve_files(spark, sf):
    """Names of every event day: good, zipped twin, wrong month folder, wrong product, other file."""
    events = bridge.raw(spark, sf, "cm").select("file_date").distinct()
    day = F.col("file_date")
    place = F.upper(F.date_format(day, "yyyy/MMM"))
    names = {p: files.day_file_name(p, day) for p in DAILY_PRODUCTS}
    root = F.lit("file:/landing/")
    found = [F.concat(root, F.lit(f"{p}/"), place, F.lit("/"), n) for p, n in names.items()]
    found += [
        F.concat(root, F.lit("cm/"), place, F.lit("/"), names["cm"], F.lit(".zip")),
        F.concat(root, F.lit("cm/"), F.lit("2023/DEC/"), names["cm"]),
        F.concat(root, F.lit("idx/"), place, F.lit("/"), names["deliv"]),
        F.concat(root, F.lit("cm/"), place, F.lit("/readme.txt")),
    ]
    paths = events.select(F.explode(F.array(*found)).alias("path"))
    return files.resolve_files(paths).select("product", "date", "name", "zipped")


#: Texts to a file: its bytes cross the blocks of a stream, and their number grows with the table.
_TEXTS_A_FILE = 500


@query(
    "file_fingerprint",
    f"""select ['cm', 'idx', 'fo', 'deliv'][k % 4 + 1] as product, DATE '2024-01-01' + cast(k as integer) as date, sha256(content) as sha256
    from (select doc_id // {_TEXTS_A_FILE} as k, string_agg(coalesce(text, ''), chr(10) order by doc_id) as content from documents group by 1)""",
)
def file_fingerprint(spark, sf):
    """Files of whole texts under the names of days, hashed on their way through the intake."""
    root = landing.fresh_folder(spark)
    k = F.floor(F.col("doc_id") / _TEXTS_A_FILE)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text")))), lambda r: r["text"])
    packed = (
        spark.read.parquet(f"{sf}/documents.parquet").groupBy(k.alias("k")).agg(F.array_join(texts, "\n").alias("content"))
        .withColumn("day", F.date_add(F.lit(START), F.col("k").cast("int")))
    )
    day, product = F.col("day"), F.element_at(F.array(*[F.lit(p) for p in ("cm", "idx", "fo", "deliv")]), (F.col("k") % 4 + 1).cast("int"))
    name = F.coalesce(*[F.when(product == p, files.day_file_name(p, day)) for p in DAILY_PRODUCTS])
    place = F.concat_ws("/", F.lit(root), product, F.upper(F.date_format(day, "yyyy/MMM")), name)
    landing.write_files(packed.select(place.alias("path"), "content"))
    parts = scan.fingerprints(spark, _parts(spark, root))
    return files.day_fingerprints(parts).select("product", "date", "sha256")


def _hashed_days(spark, sf) -> DataFrame:
    """One file per product and event day, its hash standing for the number of rows in it."""
    days = [
        bridge.raw(spark, sf, p).groupBy(F.col("file_date").alias("date"))
        .agg(F.count(F.lit(1)).cast("string").alias("n"))
        .select(F.lit(p).alias("product"), "date", F.sha2(F.col("n"), 256).alias("sha256"))
        for p in DAILY_PRODUCTS
    ]
    return union(days)


_HASHED_SQL = """hashed as (select product, date, sha256(cast(n as varchar)) as sha256 from products,
  (select file_date as date, count(*) as n from raw_cm group by 1))"""
_LOGGED_SQL = """logged as (select product, date, status, sha256(cast(n as varchar)) as sha256
  from ingest_log join (select file_date as date, count(*) as n from raw_cm where series = 'eq ' or date <> 'not-a-date' group by 1) using (date))"""


@query(
    "skip_ingested",
    f"""with {_HASHED_SQL}, {_LOGGED_SQL}
    select h.product, h.date, h.sha256 from hashed h left join (select * from logged where status = 'ingested') l
      on h.product = l.product and h.date = l.date and h.sha256 = l.sha256 where l.product is null""",
)
def skip_ingested(spark, sf):
    """Days whose row count changed since they were logged, or that were never ingested."""
    counted = bridge.view(spark, sf, "raw_cm").where("series = 'eq ' or date <> 'not-a-date'")
    known = counted.groupBy(F.col("file_date").alias("date")).agg(
        F.sha2(F.count(F.lit(1)).cast("string"), 256).alias("sha256")
    )
    log = bridge.view(spark, sf, "ingest_log").join(known, "date")
    return files.pending_days(_hashed_days(spark, sf), log)


@query(
    "non_trading_days",
    """select product, date from products, days
    where isodow(date) < 6 and date not in (select date from hol) and date not in (select file_date from raw_cm)""",
)
def non_trading_days(spark, sf):
    days = calendar.trading_days(calendar.days_between(spark, START, END))
    candidates = days.withColumn("product", F.explode(F.array(*[F.lit(p) for p in DAILY_PRODUCTS])))
    return files.non_trading_days(candidates, _hashed_days(spark, sf)).select("product", "date")


@query("scan_master", "select symbol, name, series, listing_date, isin from raw_master")
def scan_master(spark, sf):
    path = landing.fresh_folder(spark)
    raw = bridge.raw(spark, sf, "master").drop("row_no")
    raw.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return layout.normalize_headers(master.scan_master(spark, path), "master").drop("row_no")


_FILE_NAMES_SQL = {
    "cm": "'cm' || upper(strftime(file_date, '%d%b%Y')) || 'bhav.csv'",
    "idx": "'ind_close_all_' || strftime(file_date, '%d%m%Y') || '.csv'",
    "fo": "'fo' || upper(strftime(file_date, '%d%b%Y')) || 'bhav.csv.zip'",
    "deliv": "'sec_bhavdata_full_' || strftime(file_date, '%d%m%Y') || '.csv'",
}


@query(
    "add_source_file",
    " union all ".join(
        f"select '{p}' as product, file_date, {name} as source_file, count(*) as n from raw_{p} group by 2"
        for p, name in _FILE_NAMES_SQL.items()
    ),
)
def add_source_file(spark, sf):
    inspected, frames = _scanned(spark, sf)
    names = inspected.select("product", F.col("date").alias("file_date"), "name").distinct()
    rows = union([frame.select(F.lit(p).alias("product"), "file_date") for p, frame in frames])
    return (
        rows.join(names, ["product", "file_date"])
        .groupBy("product", "file_date", F.col("name").alias("source_file"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ---- stored tables --------------------------------------------------------------------------

def fresh_store(spark) -> store.Store:
    return store.Store(spark, landing.fresh_folder(spark)).create_tables()


def data(df: DataFrame, *also: str) -> DataFrame:
    """Without load times."""
    return df.drop("ingested_at", "updated_at", "generated_at", *also)


FIRST_LOAD_TO, SECOND_LOAD_FROM = dt.date(2024, 1, 20), dt.date(2024, 1, 10)


def _two_loads_sql(p: str, extra: str = "") -> str:
    """State after loading the files up to the 20th, then those from the 10th again."""
    key = ", ".join(PRODUCTS[p].key)
    return f"""select * exclude (rn, load, file_date, row_no){extra} from (
      select *, row_number() over (partition by {key} order by load desc, file_date desc, row_no) as rn from (
        select *, 1 as load, 'first.csv' as source_file from {p}_usable where file_date <= DATE '{FIRST_LOAD_TO}'
        union all select *, 2, 'second.csv' from {p}_usable where file_date >= DATE '{SECOND_LOAD_FROM}')) where rn = 1"""


def _register_upsert(key: str, p: str, method: str, extra: str = "") -> None:
    @query(key, _two_loads_sql(p, extra))
    def load(spark, sf):
        rows = cleaned(spark, sf, p).usable
        s = fresh_store(spark)
        put = getattr(s, method)
        put(rows.where(F.col("file_date") <= F.lit(FIRST_LOAD_TO)), "first.csv")
        put(rows.where(F.col("file_date") >= F.lit(SECOND_LOAD_FROM)), "second.csv")
        return data(s[PRODUCTS[p].table])


for _key, _p, _method, _extra in (
    ("upsert_bars", "cm", "upsert_bars", ""),
    ("upsert_index", "idx", "upsert_index", ""),
    ("upsert_fo", "fo", "upsert_fo", ""),
    ("upsert_deliverable", "deliv", "upsert_deliverable", ", cast(null as varchar) as isin"),
):
    _register_upsert(_key, _p, _method, _extra)


@query(
    "upsert_generic",
    """select index_name, date, cast(null as double) as open, cast(null as double) as high, cast(null as double) as low,
    close, volume, turnover, cast(null as varchar) as source_file from indices""",
)
def upsert_generic(spark, sf):
    """Columns the frame lacks are stored as null."""
    s = fresh_store(spark)
    rows = cleaned(spark, sf, "idx").usable.drop("open", "high", "low")
    s.upsert("index_daily", rows, store.last_file_first())
    return data(s["index_daily"])


_BE_MASTER = """select symbol, name, isin, series, listing_date from (select *, row_number() over (partition by symbol
  order by listing_date nulls first, row_no) rn from master_typed where symbol <> '' and series = 'BE') where rn = 1"""


@query(
    "upsert_master",
    f"""with be as ({_BE_MASTER})
    select *, 'listed' as status, cast(null as varchar) as industry, cast(null as date) as delisting_date from (
      select * from be union all select * from master where symbol not in (select symbol from be))""",
)
def upsert_master(spark, sf):
    raw = bridge.raw(spark, sf, "master")
    s = fresh_store(spark)
    s.upsert_master(clean.clean_master(raw))
    s.upsert_master(clean.clean_master(raw.where(text.col(" SERIES") == "BE")))
    return data(s["equity_master"])


@query(
    "ingest_log_latest",
    """select product, date, status, seq as num_rows from (select *, row_number() over (partition by product, date
      order by batch = 'P' desc, seq desc) as rn from log_attempts) where rn = 1""",
)
def ingest_log_latest(spark, sf):
    attempts = bridge.view(spark, sf, "log_attempts").withColumn("num_rows", F.col("seq"))
    s = fresh_store(spark)
    newest = -F.col("seq")
    s.upsert("ingest_log", attempts.where("batch <> 'P'"), newest)
    s.upsert("ingest_log", attempts.where("batch = 'P'"), newest)
    return s["ingest_log"].select("product", "date", "status", "num_rows")


@query(
    "qc_append",
    f"""select product, date, symbol, series, code, message from (
      {" union all ".join(f"select '{p}' as product, file_date as date, symbol, series, code, message from {p}_issues" for p in DAILY_PRODUCTS)})
    where product <> 'cm' or date < DATE '{SECOND_LOAD_FROM}' or code = 'OHLC_INVALID'""",
)
def qc_append(spark, sf):
    """All issues; then the later cm files come again with nothing but their OHLC issues left."""
    s = fresh_store(spark)
    for p in DAILY_PRODUCTS:
        found = cleaned(spark, sf, p).issues.select(
            F.lit(p).alias("product"), F.col("file_date").alias("date"),
            "symbol", "series", "code", "message",
        )
        s.write_qc_issues(found)
    c = cleaned(spark, sf, "cm")
    again = c.typed.where(F.col("file_date") >= F.lit(SECOND_LOAD_FROM)).select(
        F.lit("cm").alias("product"), F.col("file_date").alias("date")
    )
    left = c.issues_of("OHLC_INVALID").where(F.col("file_date") >= F.lit(SECOND_LOAD_FROM))
    s.write_qc_issues(
        left.select(F.lit("cm").alias("product"), F.col("file_date").alias("date"),
                    "symbol", "series", "code", "message"),
        again.distinct(),
    )
    return data(s["qc_issues"])


@query(
    "rekey_deliverable",
    """select symbol, series, date, quantity_traded, delivery_quantity, delivery_to_traded, cast(null as varchar) as isin,
    'old.csv' as source_file from (select *, row_number() over (partition by symbol, date order by file_date desc, row_no) as rn
      from deliv_usable) where rn = 1""",
)
def rekey_deliverable(spark, sf):
    """Rows as an older store held them: one per symbol and date, EQ written as blank."""
    rows = cleaned(spark, sf, "deliv").usable
    legacy = dedupe.keep_first(rows, ["symbol", "date"], store.last_file_first()).select(
        "symbol", F.when(F.col("series") == "EQ", "").otherwise(F.col("series")).alias("series"),
        "date", "quantity_traded", "delivery_quantity", "delivery_to_traded",
        F.lit("old.csv").alias("source_file"),
    )
    s = fresh_store(spark)
    s.rekey_deliverable(legacy)
    return data(s["deliverable_daily"])


@query(
    "create_tables",
    """select 'bhav_daily' as "table", count(*) as rows from bars
    union all select * from (values ('index_daily', 0), ('fo_daily', 0), ('deliverable_daily', 0), ('equity_master', 0),
      ('ingest_log', 0), ('qc_issues', 0), ('data_gaps', 0), ('schema_migrations', 1)) t""",
)
def create_tables(spark, sf):
    """Creating the tables again leaves what is in them."""
    s = fresh_store(spark)
    s.upsert_bars(cleaned(spark, sf, "cm").usable, "a.csv")
    s.create_tables()
    return templates.count_rows(s, tuple(TABLES))


@query(
    "table_scan",
    f"""select *, 'a.csv' as source_file from bars where date between DATE '{SECOND_LOAD_FROM}' and DATE '{FIRST_LOAD_TO}'""",
)
def table_scan(spark, sf):
    s = fresh_store(spark)
    s.upsert_bars(cleaned(spark, sf, "cm").usable, "a.csv")
    return data(s.table("bhav_daily", SECOND_LOAD_FROM, FIRST_LOAD_TO))


# ---- export ---------------------------------------------------------------------------------

_EXPORT_SQL = f"""select * from bars where series = 'EQ' and date >= DATE '{SECOND_LOAD_FROM}' and date <= DATE '{FIRST_LOAD_TO}'"""
_EXPORT = {"series": "EQ", "start": SECOND_LOAD_FROM, "end": FIRST_LOAD_TO}


@query("export_parquet", _EXPORT_SQL)
def export_parquet(spark, sf):
    out = landing.fresh_folder(spark)
    export.export_table(Tables(spark, sf), "bhav_daily", out, fmt="parquet", **_EXPORT)
    return spark.read.parquet(out)


@query("export_csv", _EXPORT_SQL)
def export_csv(spark, sf):
    tables = Tables(spark, sf)
    out = landing.fresh_folder(spark)
    export.export_table(tables, "bhav_daily", out, fmt="csv", **_EXPORT)
    return spark.read.schema(tables["bhav_daily"].schema).option("header", True).csv(out)


@query(
    "export_filtered",
    """select 'index_daily' as "table", index_name as name, date, close from indices
      where index_name in ('NIFTY 50', 'NIFTY 100') and index_name in ('NIFTY 100', 'NIFTY 10') and date >= DATE '2024-01-05'
    union all select 'fo_daily', symbol, date, close from futures where symbol in ('NIFTY') and date <= DATE '2024-01-20'
    union all select 'deliverable_daily', symbol, date, null from deliverables where date >= DATE '2024-01-05'
    union all select 'equity_master', symbol, listing_date, null from master""",
)
def export_filtered(spark, sf):
    tables = Tables(spark, sf)
    low, high = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    none = F.lit(None).cast("double")

    def rows(table: str, name: str, date: str, close, **filters) -> DataFrame:
        return export.export_rows(tables, table, **filters).select(
            F.lit(table).alias("table"), F.col(name).alias("name"), F.col(date).alias("date"),
            close.alias("close"),
        )

    return union(
        [
            rows("index_daily", "index_name", "date", F.col("close"), start=low,
                 symbols=["NIFTY 50", "NIFTY 100"], indexes=["NIFTY 100", "NIFTY 10"]),
            rows("fo_daily", "symbol", "date", F.col("close"), symbols=["NIFTY"], end=high),
            # a series filter applies to the bars only
            rows("deliverable_daily", "symbol", "date", none, series="N1", start=low),
            rows("equity_master", "symbol", "listing_date", none, start=low),
        ]
    )


# ---- calendar -------------------------------------------------------------------------------

def _log_days(spark, sf) -> DataFrame:
    """One row: first and last day of the log."""
    return bridge.view(spark, sf, "log_attempts").agg(
        F.min("date").alias("start"), F.max("date").alias("end")
    )


_LOG_DAYS_SQL = """log_days as (select cast(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) as date) as date from log_attempts)"""


@query("date_range", f"with {_LOG_DAYS_SQL} select date from log_days")
def date_range(spark, sf):
    return calendar.date_range(_log_days(spark, sf)).select("date")


@query("weekdays", f"with {_LOG_DAYS_SQL} select date from log_days where isodow(date) < 6")
def weekdays(spark, sf):
    return calendar.weekdays(calendar.date_range(_log_days(spark, sf)).select("date"))


@query(
    "trading_days",
    f"with {_LOG_DAYS_SQL} select date from log_days where isodow(date) < 6 and date not in (select date from hol)",
)
def trading_days(spark, sf):
    return calendar.trading_days(calendar.date_range(_log_days(spark, sf)).select("date"))


@query(
    "holidays",
    """select year(date) as year, date, coalesce(n, 0) as n_attempts from hol
    left join (select date, count(*) as n from log_attempts group by 1) using (date)""",
)
def holidays(spark, sf):
    attempts = bridge.view(spark, sf, "log_attempts").groupBy("date").agg(
        F.count(F.lit(1)).alias("n")
    )
    return calendar.holidays(spark).join(attempts, "date", "left").select(
        "year", "date", F.coalesce("n", F.lit(0)).alias("n_attempts")
    )


@query(
    "is_holiday",
    """select date, date in (select date from hol) as is_holiday, count(*) as n_attempts from log_attempts group by 1""",
)
def is_holiday(spark, sf):
    return (
        bridge.view(spark, sf, "log_attempts")
        .groupBy("date", calendar.is_holiday(F.col("date")).alias("is_holiday"))
        .agg(F.count(F.lit(1)).alias("n_attempts"))
    )


@query(
    "month_bounds",
    """select cast(date_trunc('month', o_orderdate) as date) as first, last_day(o_orderdate) as last, count(*) as n_orders
    from orders group by 1, 2""",
)
def month_bounds(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return (
        spark.read.parquet(f"{sf}/orders.parquet")
        .groupBy(calendar.month_start(day).alias("first"), calendar.month_end(day).alias("last"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


@query(
    "scalar_functions",
    f"""select row_no, round(close / prev_close, 2) as rounded, abs(close - open) as distance, strftime(file_date, '%Y-%m') as month,
    coalesce(nullif({oracle._ident('symbol')}, ''), 'EQ') as filled, length({oracle._strip('symbol')}) as n_chars,
    greatest(open, low, close) as top, least(open, high, close) as bottom
    from (select row_no, file_date, symbol, {oracle._double('close')} as close, {oracle._double('prev_close')} as prev_close,
      {oracle._double('open')} as open, {oracle._double('low')} as low, {oracle._double('high')} as high from raw_cm)""",
)
def scalar_functions(spark, sf):
    raw = layout.normalize_headers(bridge.raw(spark, sf, "cm"), "cm")
    price = {c: text.to_double(F.col(c)) for c in ("open", "high", "low", "close", "prev_close")}
    return raw.select(
        "row_no",
        text.round_to(F.try_divide(price["close"], price["prev_close"]), 2).alias("rounded"),
        F.abs(price["close"] - price["open"]).alias("distance"),
        F.date_format("file_date", "yyyy-MM").alias("month"),
        text.blank_to(F.col("symbol"), "EQ").alias("filled"),
        F.length(text.strip(F.col("symbol"))).alias("n_chars"),
        F.greatest(price["open"], price["low"], price["close"]).alias("top"),
        F.least(price["open"], price["high"], price["close"]).alias("bottom"),
    )


# ---- log and reports ------------------------------------------------------------------------

@query("month_coverage", "select * from month_cov")
def month_coverage(spark, sf):
    log = bridge.view(spark, sf, "ingest_log")
    return coverage.month_coverage(log, list(DAILY_PRODUCTS), START, END)


@query("detect_gaps", "select * from gaps")
def detect_gaps(spark, sf):
    log = bridge.view(spark, sf, "ingest_log")
    return coverage.detect_gaps(log, list(DAILY_PRODUCTS), START, END)


def _gap_rows(spark, sf) -> DataFrame:
    tables = Tables(spark, sf)
    return coverage.gap_rows(
        coverage.detect_gaps(tables["ingest_log"], list(DAILY_PRODUCTS), START, END),
        anomalies.master_drift(tables["bhav_daily"], tables["equity_master"]),
        list(DAILY_PRODUCTS),
        END,
    )


@query("gap_rows", "select product, date, gap_type, detail from gap_table")
def gap_rows(spark, sf):
    return _gap_rows(spark, sf)


@query("refresh_gaps", "select product, date, gap_type, detail from gap_table where product <> 'idx'")
def refresh_gaps(spark, sf):
    """Twice over for one product, and emptied for another."""
    rows = _gap_rows(spark, sf)
    s = fresh_store(spark)
    for p in ("cm", *DAILY_PRODUCTS):
        s.refresh_gaps(p, rows.where(F.col("product") == p))
    s.refresh_gaps("idx", rows.where(F.lit(False)))
    return data(s["data_gaps"])


@query("log_range", 'select product, min(date) as first, max(date) as last from ingest_log group by 1')
def log_range(spark, sf):
    return coverage.log_range(bridge.view(spark, sf, "ingest_log"))


@query(
    "status_by_month",
    """select product, strftime(date, '%Y-%m') as month, count(*) filter (status in ('ingested', 'skipped')) as data_days,
    count(*) filter (status = 'not_a_trading_day') as holidays, count(*) filter (status = 'error') as errors
    from ingest_log group by 1, 2 order by 2 desc, 1 limit 24""",
)
def status_by_month(spark, sf):
    return coverage.status_by_month(bridge.view(spark, sf, "ingest_log"))


@query("cross_tables", "select * from cross_cov")
def cross_tables(spark, sf):
    return coverage.cross_tables(Tables(spark, sf), START, END)


@query(
    "ingest_summary",
    """select product, count(*) filter (status = 'ingested') as ingested, count(*) filter (status = 'skipped') as skipped,
    count(*) filter (status = 'not_a_trading_day') as non_trading, count(*) filter (status = 'error') as errors,
    cast(coalesce(sum(seq) filter (status = 'ingested'), 0) as bigint) as rows from ingest_log group by 1""",
)
def ingest_summary(spark, sf):
    return ingest.ingest_summary(
        bridge.view(spark, sf, "ingest_log").withColumnRenamed("seq", "num_rows")
    )


@query(
    "status_totals",
    """select 'bhav_daily' as "table", count(*) as rows from bars union all select 'equity_master', count(*) from master
    union all select 'data_gaps', count(*) from gap_table""",
)
def status_totals(spark, sf):
    tables = Tables(spark, sf)
    tables["data_gaps"] = _gap_rows(spark, sf)
    return templates.count_rows(tables, ("bhav_daily", "equity_master", "data_gaps"))


def _report(spark, sf) -> report.Report:
    return report.build_report(Tables(spark, sf), "cm", START, END, generated_at="now")


@query(
    "build_report",
    f"""select 'coverage' as part, month as item, data_days as value from month_cov where product = 'cm'
    union all select 'gaps', gap_type, count(*) from gaps where product = 'cm' group by 2
    union all {" union all ".join(f"select 'anomalies', '{c}', count(*) from ({_ANOMALY_SQL[c]})" for c in anomalies.CODES)}
    union all select 'drift', 'symbols', count(*) from drift
    union all select 'cross', "table", rows from cross_cov""",
)
def build_report(spark, sf):
    r = _report(spark, sf)
    many = F.count(F.lit(1)).alias("value")
    return union(
        [
            r.coverage.select(F.lit("coverage").alias("part"), F.col("month").alias("item"),
                              F.col("data_days").alias("value")),
            r.gaps.groupBy(F.col("gap_type").alias("item")).agg(many)
            .select(F.lit("gaps").alias("part"), "item", "value"),
            r.counts.select(F.lit("anomalies").alias("part"), F.col("code").alias("item"),
                            F.col("count").alias("value")),
            r.drift.agg(many).select(F.lit("drift").alias("part"),
                                     F.lit("symbols").alias("item"), "value"),
            r.cross.select(F.lit("cross").alias("part"), F.col("table").alias("item"),
                           F.col("rows").alias("value")),
        ]
    )


_COLUMNS = {
    "EXTREME_MOVE": "prev_close | close",
    "ZERO_VOLUME_WITH_TRADES": "total_traded_quantity | no_of_trades",
    "NEGATIVE_PRICE": "open | high | low | close",
    "DELIVERY_MISMATCH": "delivery_qty | delivery_quantity",
}


def _anomaly_lines_sql(code: str, no: int) -> str:
    columns = ["symbol", "date", *_COLUMNS[code].split(" | ")]
    header = " | ".join(columns)
    rule = " | ".join("---" for _ in columns)
    sample = _sample_sql(code)
    cells = sample
    for i, c in enumerate(columns):
        cells = cells.replace(f"'{c}='", "'| '" if i == 0 else "''").replace("|| ', ' ||", "|| ' | ' ||")
    count = f"(select count(*) as n from ({_ANOMALY_SQL[code]}))"
    return " union all ".join(
        [
            f"select {no}000 as ord, '### {code} (' || n || ')' as line from {count}",
            f"select {no}001, '' from {count} where n > 0",
            f"select {no}002, '| {header} |' from {count} where n > 0",
            f"select {no}003, '| {rule} |' from {count} where n > 0",
            f"select {no}003 + ord, sample || ' |' from ({cells})",
            f"select case when n > 0 then {no}004 + least(n, 5) else {no}001 end, '' from {count}",
        ]
    )


def _gap_list_sql(kind: str, most: int | None = None) -> str:
    top = f"order by date limit {most}" if most else ""
    return (
        f"(select string_agg(cast(date as varchar), ', ' order by date) as dates, count(*) as n "
        f"from (select date from gaps where product = 'cm' and gap_type = '{kind}' {top}))"
    )


def _gap_lines_sql() -> str:
    kinds = [
        ("missing_attempt", 50, "Missing attempts (weekdays with no record):"),
        ("ingest_error", None, "Ingest errors:"),
        ("unknown_holiday", None, "Unknown holidays detected by source (add to the calendar):"),
    ]
    rows = ["select 0 as k, '' as line", "select 1, '## Gaps'", "select 2, ''"]
    for i, (kind, most, title) in enumerate(kinds):
        found = _gap_list_sql(kind, most)
        rows += [
            f"select {10 * i + 10}, '{title}' from {found} where n > 0",
            f"select {10 * i + 11}, ' - ' || dates from {found} where n > 0",
            f"select {10 * i + 12}, '' from {found} where n > 0",
        ]
    rows += ["select 90, '## Anomalies'", "select 91, ''"]
    union_all = " union all ".join(rows)
    return f"select 3 as section, row_number() over (order by k) - 1 as ord, line from ({union_all})"


def _values(section: int, lines: list[str]) -> str:
    rows = ", ".join(f"({i}, {line})" for i, line in enumerate(lines))
    return f"select {section} as section, ord, line from (values {rows}) t(ord, line)"


_GAPS_LINE = (
    "(select '- gaps: ' || count(*) filter (gap_type = 'missing_attempt') || ' missing, ' || "
    "count(*) filter (gap_type = 'ingest_error') || ' errors, ' || "
    "count(*) filter (gap_type = 'unknown_holiday') || ' unknown holidays' from gaps where product = 'cm')"
)
_REPORT_LINES_SQL = " union all ".join(
    [
        _values(1, [
            "'# data-quality report — cm'", "''", "'- generated: now'",
            f"'- range: {START} .. {END}'", _GAPS_LINE, "''", "'## Monthly coverage'", "''",
            "'| month | expected | data days | holidays | errors | coverage |'",
            "'| ------ | -------: | --------: | -------: | -----: | -------: |'",
        ]),
        """select 2, cast(replace(month, '-', '') as bigint) * 1000, '| ' || month || ' | ' || expected || ' | ' || data_days || ' | '
          || holidays || ' | ' || errors || ' | ' || cast(cast(coverage_pct as double) as varchar) || '% |' from month_cov where product = 'cm'""",
        _gap_lines_sql(),
        *[
            f"select 4, ord, line from ({_anomaly_lines_sql(c, i)})"
            for i, c in enumerate(anomalies.CODES, 1)
        ],
        _values(5, [
            "'## Equity master drift'", "''",
            "(select coalesce('EQ symbols with bars but missing from the master: ' || string_agg(symbol, ', ' order by symbol), 'none') "
            "from (select symbol from drift order by symbol limit 50))",
            "''", "'## Cross-dataset coverage'", "''",
            "'| table | days | rows | first | last |'", "'| --- | ---: | ---: | --- | --- |'",
        ]),
        """select 6, list_position(['index_daily', 'fo_daily', 'deliverable_daily'], "table") * 1000, '| ' || "table" || ' | ' || days
          || ' | ' || rows || ' | ' || coalesce(cast(first as varchar), '-') || ' | ' || coalesce(cast(last as varchar), '-') || ' |' from cross_cov""",
        "select 7, 0, ''",
    ]
)


@query("report_lines", _REPORT_LINES_SQL)
def report_lines(spark, sf):
    return report.report_lines(_report(spark, sf))


def _json_dates(kind: str) -> str:
    return (
        "(select '[' || coalesce(string_agg('\"' || cast(date as varchar) || '\"', ',' order by date), '') || ']' "
        f"from gaps where product = 'cm' and gap_type = '{kind}')"
    )


def _json_code(code: str, no: int) -> str:
    columns = ["symbol", "date", *_COLUMNS[code].split(" | ")]
    one = "'{' || " + " || ',' || ".join(
        f"""'"{c}":"' || cast({c} as varchar) || '"'""" for c in columns
    ) + " || '}'"
    inner = _sample_sql(code)
    rows = inner[inner.index("from (select *"):]
    return (
        f"select 4, '{no}', '{',' if no > 1 else ''}{{\"code\":\"{code}\",\"count\":' || "
        f"(select count(*) from ({_ANOMALY_SQL[code]})) || ',\"samples\":[' || "
        f"coalesce((select string_agg({one}, ',' order by ord) {rows}), '') || ']}}'"
    )


_BOUNDS = f'"start":"{START}","end":"{END}"'
_REPORT_JSON_SQL = " union all ".join(
    [
        f"""select 1 as section, '' as ord, '{{"product":"cm","generated_at":"now",{_BOUNDS},"coverage":[' as line""",
        f"""select 2, month, case when month = '{START:%Y-%m}' then '' else ',' end || '{{"product":"cm","month":"' || month || '","expected":' || expected
          || ',"data_days":' || data_days || ',"holidays_detected":' || holidays || ',"errors":' || errors || ',"coverage_pct":'
          || cast(cast(coverage_pct as double) as varchar) || '}}' from month_cov where product = 'cm'""",
        f"""select 3, '', '],"gaps":{{"product":"cm",{_BOUNDS},"missing_attempts":' || {_json_dates('missing_attempt')} || ',"errors":'
          || {_json_dates('ingest_error')} || ',"unknown_holidays":' || {_json_dates('unknown_holiday')} || '}},"anomalies":['""",
        *[_json_code(c, i) for i, c in enumerate(anomalies.CODES, 1)],
        """select 5, '', '],"master_drift":['""",
        """select 6, symbol, case when symbol = (select min(symbol) from drift) then '' else ',' end || '"' || symbol || '"' from drift""",
        """select 7, '', '],"cross_tables":['""",
        """select 8, cast(no as varchar), case when no = 1 then '' else ',' end || '{"table":"' || "table" || '","days":' || days || ',"rows":' || rows
          || ',"first":' || coalesce('"' || first || '"', 'null') || ',"last":' || coalesce('"' || last || '"', 'null') || '}'
          from (select *, list_position(['index_daily', 'fo_daily', 'deliverable_daily'], "table") as no from cross_cov)""",
        "select 9, '', ']}'",
    ]
)


@query("report_json", _REPORT_JSON_SQL)
def report_json(spark, sf):
    return report.report_json(_report(spark, sf))


# ---- SQL and whole ingests ------------------------------------------------------------------

@query(
    "run_sql",
    "select series, count(*) as bars, max(close) as top_close from bars group by series",
)
def run_sql(spark, sf):
    tables = Tables(spark, sf)
    tables["bhav_daily"].createOrReplaceTempView("bhav_daily")
    return sql.run_sql(
        spark,
        """SELECT series, count(*) AS bars, max(close) AS top_close FROM bhav_daily
        GROUP BY series ORDER BY series; -- per series""".replace("; --", " --"),
    )


def _event_days(spark, sf) -> list[dt.date]:
    days = bridge.raw(spark, sf, "cm").select("file_date").distinct().collect()
    return sorted(d.file_date for d in days)


#: Columns that no file fills.
_UNFILLED = {"deliv": ", cast(null as varchar) as isin"}


def _last_sql(p: str) -> str:
    key = ", ".join(PRODUCTS[p].key)
    return f"""select '{p}' as product, * exclude (rn, file_date, row_no){_UNFILLED.get(p, "")}, {_FILE_NAMES_SQL[p]} as source_file
      from (select *, row_number() over (partition by {key} order by file_date desc, row_no) as rn from {p}_usable) where rn = 1"""


def _all_tables(s: Store, *also: str) -> DataFrame:
    """Every key and value column of the daily tables, told apart by product."""
    frames = [data(s[PRODUCTS[p].table], *also).withColumn("product", F.lit(p)) for p in DAILY_PRODUCTS]
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


@query("ingest_incremental", " union all by name ".join(_last_sql(p) for p in DAILY_PRODUCTS))
def ingest_incremental(spark, sf):
    """Files of all products up to the 20th arrive and are streamed in; then the rest, with one stream checkpoint."""
    root = landing.fresh_folder(spark)
    s = fresh_store(spark)
    early = F.col("file_date") <= F.lit(FIRST_LOAD_TO)
    for arrived in (early, ~early):
        _landed(spark, {p: bridge.raw(spark, sf, p, ordered=True).where(arrived) for p in DAILY_PRODUCTS}, root)
        incremental.ingest_stream(s, root, f"{s.root}-stream", DAILY_PRODUCTS).awaitTermination()
    return _all_tables(s)


#: What the restated files say: a header of each product, and the column it fills.
_RESTATED = {
    "cm": ("TTL_TRD_QNTY", "total_traded_quantity"), "idx": ("Volume", "volume"),
    "fo": ("CONTRACTS", "contracts"), "deliv": (" TTL_TRD_QNTY", "quantity_traded"),
}
RESTATED_FROM = dt.date(2024, 1, 28)


def _restated_sql(p: str) -> str:
    key, column = ", ".join(PRODUCTS[p].key), _RESTATED[p][1]
    return f"""select '{p}' as product, * exclude (rn, load, file_date, row_no, {column}), case when load = 2 then 7 else {column} end as {column}{_UNFILLED.get(p, "")}
    from (select *, row_number() over (partition by {key} order by load desc, file_date desc, row_no) as rn from (
      select *, 1 as load from {p}_usable union all select *, 2 from {p}_usable where file_date >= DATE '{RESTATED_FROM}')) where rn = 1"""


@query("restate_day", " union all by name ".join(_restated_sql(p) for p in DAILY_PRODUCTS))
def restate_day(spark, sf):
    """All days of all products, then the last ones again under the same names with other quantities."""
    root = _landing(spark, sf)
    s = fresh_store(spark)
    days = _event_days(spark, sf)
    ingest.update_days(s, root, dict.fromkeys(DAILY_PRODUCTS, days))
    late = F.col("file_date") >= F.lit(RESTATED_FROM)
    _landed(spark, {p: bridge.raw(spark, sf, p, ordered=True).where(late).withColumn(h, F.lit("7")) for p, (h, _) in _RESTATED.items()}, root)
    for again in ingest.update_days(s, root, dict.fromkeys(DAILY_PRODUCTS, days)):
        assert again.skipped == sum(d < RESTATED_FROM for d in days), again
    return _all_tables(s, "source_file")


# ---- named queries as a user runs them: over a store, by folder -----------------------------

_STORED = {
    "bhav_daily": ("top_gainers", "top_losers", "volume_leaders"),
    "fo_daily": ("fo_most_traded", "fo_open_interest"),
    "index_daily": ("index_history",),
}


def _register_stored(name: str, tables: tuple[str, ...]) -> None:
    @query(f"stored_{name}", _TEMPLATE_SQL[name])
    def stored(spark, sf):
        """The named query over a loaded store: only folders of the days it needs are opened."""
        s = fresh_store(spark)
        for product in DAILY_PRODUCTS:
            if PRODUCTS[product].table in tables:
                s.upsert(PRODUCTS[product].table, cleaned(spark, sf, product).usable, store.last_file_first())
        return templates.execute_template(s, name)


for _table, _names in _STORED.items():
    for _name in _names:
        _register_stored(_name, (_table,))
for _name in ("delivery_spike", "delivery_ratio"):
    _register_stored(_name, ("bhav_daily", "deliverable_daily"))
