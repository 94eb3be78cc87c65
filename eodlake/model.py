"""Tables, keys, products and header names.

Names, keys and header spellings below are fixed values: stored tables and incoming files
use exactly these words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SCHEMA_VERSION = 2

INGESTED = "ingested"
SKIPPED = "skipped"
ERROR = "error"
NON_TRADING = "not_a_trading_day"

# one lakh; turnover columns named *_LACS / *_INLAKH are multiplied by it
LAKH = 100000


_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema of "name type, ..." (Spark's own DDL reader needs a running session)."""
    schema = T.StructType()
    for column in columns.split(", "):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


@dataclass(frozen=True)
class Table:
    """A stored table.

    `key` is its primary key and `partition` its folder layout. Columns in `carried` keep the
    value of the row they replace.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    partition: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    carried: tuple[str, ...] = ("ingested_at",)
    symbol: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# Table names, columns and keys.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "bhav_daily",
            _schema(
                "symbol string, series string, date date, prev_close double, open double, "
                "high double, low double, last double, close double, avg_price double, "
                "total_traded_quantity bigint, turnover double, no_of_trades bigint, "
                "delivery_qty bigint, delivery_pct double, source_file string, "
                "ingested_at timestamp"
            ),
            key=("symbol", "series", "date"),
            partition=("date",),
            not_null=(
                "symbol", "series", "date", "total_traded_quantity", "turnover",
                "no_of_trades", "delivery_qty", "delivery_pct",
            ),
            symbol="symbol",
        ),
        Table(
            "index_daily",
            _schema(
                "index_name string, date date, open double, high double, low double, "
                "close double, volume bigint, turnover double, source_file string, "
                "ingested_at timestamp"
            ),
            key=("index_name", "date"),
            partition=("date",),
            not_null=("index_name", "date", "volume", "turnover"),
            symbol="index_name",
        ),
        Table(
            "fo_daily",
            _schema(
                "instrument string, symbol string, expiry_date date, option_type string, "
                "strike_price double, date date, open double, high double, low double, "
                "close double, settle_price double, contracts bigint, value double, "
                "open_interest bigint, change_in_oi bigint, source_file string, "
                "ingested_at timestamp"
            ),
            key=("instrument", "symbol", "expiry_date", "option_type", "strike_price", "date"),
            partition=("date",),
            not_null=(
                "instrument", "symbol", "expiry_date", "option_type", "strike_price", "date",
                "contracts", "value", "open_interest", "change_in_oi",
            ),
            symbol="symbol",
        ),
        Table(
            "deliverable_daily",
            _schema(
                "symbol string, series string, date date, isin string, "
                "quantity_traded bigint, delivery_quantity bigint, delivery_to_traded double, "
                "source_file string, ingested_at timestamp"
            ),
            key=("symbol", "series", "date"),
            partition=("date",),
            not_null=("symbol", "series", "date", "quantity_traded", "delivery_quantity"),
            symbol="symbol",
        ),
        Table(
            "equity_master",
            _schema(
                "symbol string, name string, isin string, industry string, series string, "
                "listing_date date, delisting_date date, status string, updated_at timestamp"
            ),
            key=("symbol",),
            not_null=("symbol",),
            carried=("industry", "delisting_date"),
        ),
        Table(
            "ingest_log",
            _schema(
                "product string, date date, source_url string, file_name string, "
                "sha256 string, num_rows bigint, status string, error string, "
                "duration_sec double, ingested_at timestamp"
            ),
            key=("product", "date"),
            partition=("product",),
            not_null=("product", "date", "num_rows", "status"),
        ),
        Table(
            "qc_issues",
            _schema(
                "product string, date date, symbol string, series string, code string, "
                "message string, ingested_at timestamp"
            ),
            key=(),
            partition=("product", "date"),
        ),
        Table(
            "data_gaps",
            _schema(
                "product string, date date, gap_type string, detail string, "
                "generated_at timestamp"
            ),
            key=("product", "date", "gap_type"),
            partition=("product",),
        ),
        Table(
            "schema_migrations",
            _schema("version int, applied_at timestamp"),
            key=("version",),
            carried=("applied_at",),
        ),
    )
}

EXPORTABLE = (
    "bhav_daily", "index_daily", "fo_daily", "deliverable_daily", "equity_master",
)


@dataclass(frozen=True)
class Product:
    """How one kind of day file maps to its table.

    `headers` gives, per table column, the file headers it may come under; the column named by
    `scaled[0]` is in lakhs when it arrives under header `scaled[1]`.
    """

    code: str
    table: str
    headers: dict[str, tuple[str, ...]]
    required: tuple[str, ...]
    date_pattern: str
    scaled: tuple[str, str] | None = None

    @property
    def key(self) -> tuple[str, ...]:
        return TABLES[self.table].key


# Header spellings (compared after trimming and upper-casing) and date formats.
PRODUCTS: dict[str, Product] = {
    p.code: p
    for p in (
        Product(
            "cm",
            "bhav_daily",
            {
                "symbol": ("SYMBOL",),
                "series": ("SERIES",),
                "date": ("DATE", "TIMESTAMP"),
                "prev_close": ("PREV_CLOSE", "PREVCLOSE"),
                "open": ("OPEN_PRICE", "OPEN"),
                "high": ("HIGH_PRICE", "HIGH"),
                "low": ("LOW_PRICE", "LOW"),
                "last": ("LAST_PRICE", "LAST"),
                "close": ("CLOSE_PRICE", "CLOSE"),
                "avg_price": ("AVG_PRICE",),
                "total_traded_quantity": ("TTL_TRD_QNTY", "TOTTRDQTY"),
                "turnover": ("TURNOVER_LACS", "TOTTRDVAL"),
                "no_of_trades": ("NO_OF_TRADES", "TOTALTRADES"),
                "delivery_qty": ("DELIV_QTY",),
                "delivery_pct": ("DELIV_PER",),
            },
            required=("symbol", "series", "date", "open", "high", "low", "close"),
            date_pattern="d-MMM-yyyy",
            scaled=("turnover", "TURNOVER_LACS"),
        ),
        Product(
            "idx",
            "index_daily",
            {
                "index_name": ("INDEX NAME",),
                "date": ("INDEX DATE",),
                "open": ("OPEN INDEX VALUE",),
                "high": ("HIGH INDEX VALUE",),
                "low": ("LOW INDEX VALUE",),
                "close": ("CLOSING INDEX VALUE",),
                "volume": ("VOLUME",),
                "turnover": ("TURNOVER (RS. CR.)",),
            },
            required=("index_name", "date", "open", "high", "low", "close"),
            date_pattern="d-M-yyyy",
        ),
        Product(
            "fo",
            "fo_daily",
            {
                "instrument": ("INSTRUMENT",),
                "symbol": ("SYMBOL",),
                "expiry_date": ("EXPIRY_DT",),
                "option_type": ("OPTION_TYP",),
                "strike_price": ("STRIKE_PR", "STRIKE_PRC"),
                "date": ("TIMESTAMP",),
                "open": ("OPEN",),
                "high": ("HIGH",),
                "low": ("LOW",),
                "close": ("CLOSE",),
                "settle_price": ("SETTLE_PR",),
                "contracts": ("CONTRACTS",),
                "value": ("VAL_INLAKH",),
                "open_interest": ("OPEN_INT",),
                "change_in_oi": ("CHG_IN_OI",),
            },
            required=("instrument", "symbol", "open", "high", "low", "close"),
            date_pattern="d-MMM-yyyy",
            scaled=("value", "VAL_INLAKH"),
        ),
        Product(
            "deliv",
            "deliverable_daily",
            {
                "symbol": ("SYMBOL",),
                "series": ("SERIES",),
                "date": ("DATE1",),
                "quantity_traded": ("TTL_TRD_QNTY",),
                "delivery_quantity": ("DELIV_QTY",),
                "delivery_to_traded": ("DELIV_PER",),
            },
            required=("symbol", "date"),
            date_pattern="d-MMM-yyyy",
        ),
        Product(
            "master",
            "equity_master",
            {
                "symbol": ("SYMBOL",),
                "name": ("NAME OF COMPANY", "COMPANY NAME"),
                "series": ("SERIES",),
                "isin": ("ISIN NUMBER", "ISIN"),
                "listing_date": ("DATE OF LISTING",),
            },
            required=("symbol", "series"),
            date_pattern="d-MMM-yyyy",
        ),
    )
}

DAILY_PRODUCTS = ("cm", "idx", "fo", "deliv")
LISTING_DATE_PATTERNS = ("d-MMM-yyyy", "d-MMMM-yyyy", "yyyy-MM-dd")

# Advisory exchange holidays.
HOLIDAYS = (
    "2023-01-26", "2023-03-07", "2023-03-30", "2023-04-04", "2023-04-07", "2023-04-14",
    "2023-05-01", "2023-06-28", "2023-08-15", "2023-09-18", "2023-10-24", "2023-11-27",
    "2023-12-25",
    "2024-01-22", "2024-01-26", "2024-03-08", "2024-03-25", "2024-03-29", "2024-04-11",
    "2024-05-01", "2024-06-17", "2024-07-08", "2024-08-15", "2024-10-02", "2024-11-01",
    "2024-11-15", "2024-12-25",
    "2025-02-26", "2025-03-14", "2025-03-31", "2025-04-10", "2025-04-14", "2025-04-18",
    "2025-05-01", "2025-05-12", "2025-08-15", "2025-08-27", "2025-10-02", "2025-10-21",
    "2025-11-05", "2025-12-25",
    "2026-02-17", "2026-03-04", "2026-04-01", "2026-04-03", "2026-05-01", "2026-08-15",
    "2026-10-02", "2026-11-09", "2026-12-25",
)
