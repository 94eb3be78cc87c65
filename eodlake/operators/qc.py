"""Row quality checks on a typed frame. Issue rows are (file_date, symbol, series, code, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISSUE = "struct<symbol:string,series:string,code:string,message:string>"
ISSUE_COLUMNS = ("file_date", "symbol", "series", "code", "message")
TOLERANCE = 0.001


def identifier_column(product: str) -> str:
    return "index_name" if product == "idx" else "symbol"


# ---- row predicates -------------------------------------------------------------------------

def resolved_date(product: str) -> Column:
    """The row's date; an F&O row without one takes the day of its file."""
    date = F.col("date")
    return F.coalesce(date, F.col("file_date")) if product == "fo" else date


def dated(product: str) -> Column:
    return resolved_date(product).isNotNull()


def expires(product: str) -> Column:
    return F.col("expiry_date").isNotNull() if product == "fo" else F.lit(True)


def named(product: str) -> Column:
    """Not blank. A null identifier is no issue, but the row is dropped all the same."""
    return F.length(identifier_column(product)) > 0


def usable(product: str) -> Column:
    return dated(product) & expires(product) & F.coalesce(named(product), F.lit(False))


def wrong_day(product: str) -> Column:
    """The row's own date differs from the day of its file (F&O: before the date is filled)."""
    return F.coalesce(F.col("date") != F.col("file_date"), F.lit(False))


def ohlc_invalid(has_prev_close: bool) -> Column:
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    bad = (h + TOLERANCE < F.greatest(o, lo, c)) | (lo - TOLERANCE > F.least(o, h, c))
    if has_prev_close:
        bad = bad | (F.coalesce(F.col("prev_close") < 0, F.lit(False)))
    return F.coalesce(bad, F.lit(False))


# ---- issue rows -----------------------------------------------------------------------------

def _issue(code: str, message: Column, symbol: Column | None = None, series: Column | None = None):
    none = F.lit(None).cast("string")
    return F.struct(
        (none if symbol is None else symbol).alias("symbol"),
        (none if series is None else series).alias("series"),
        F.lit(code).alias("code"),
        message.alias("message"),
    )


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def _bad_date(product: str) -> tuple[Column, Column]:
    message = F.concat(
        F.lit("unparsable date "),
        F.coalesce(F.concat(F.lit("'"), F.col("date_text"), F.lit("'")), F.lit("None")),
    )
    series = F.col("series") if product == "cm" else None
    return ~dated(product), _issue(
        "BAD_DATE", message, F.col(identifier_column(product)), series
    )


def _date_mismatch(product: str) -> tuple[Column, Column]:
    message = F.concat(
        F.lit("file date "), _text("file_date"), F.lit(" but row date "), _text("date")
    )
    series = F.col("series") if product == "cm" else None
    kept = F.lit(True) if product == "fo" else usable(product)
    return kept & wrong_day(product), _issue(
        "DATE_MISMATCH", message, F.col(identifier_column(product)), series
    )


def _ohlc(product: str) -> tuple[Column, Column]:
    message = F.concat(
        F.lit("open="), _text("open"), F.lit(" high="), _text("high"),
        F.lit(" low="), _text("low"), F.lit(" close="), _text("close"),
        F.lit(" violates OHLC bounds"),
    )
    return usable(product) & ohlc_invalid(product == "cm"), _issue(
        "OHLC_INVALID", message, F.col(identifier_column(product))
    )


def _expiry_missing(product: str) -> tuple[Column, Column]:
    message = F.concat(F.lit("row without expiry: instrument="), _text("instrument"))
    return dated(product) & ~expires(product), _issue(
        "EXPIRY_MISSING", message, F.col("symbol")
    )


_ROW_CHECKS = {
    "BAD_DATE": (_bad_date, ("cm", "idx", "deliv")),
    "DATE_MISMATCH": (_date_mismatch, ("cm", "idx", "fo", "deliv")),
    "OHLC_INVALID": (_ohlc, ("cm", "idx")),
    "EXPIRY_MISSING": (_expiry_missing, ("fo",)),
}


def row_codes(product: str) -> list[str]:
    return [code for code, (_, products) in _ROW_CHECKS.items() if product in products]


def row_issues(typed: DataFrame, product: str, codes: list[str] | None = None) -> DataFrame:
    """Issues of single rows, before deduplication: one narrow pass, no shuffle."""
    checks = [
        _ROW_CHECKS[code][0](product) for code in row_codes(product)
        if codes is None or code in codes
    ]
    found = F.array(*[F.when(hit, issue) for hit, issue in checks])
    return (
        typed.select("file_date", F.explode(F.array_compact(found)).alias("issue"))
        .select("file_date", "issue.*")
    )


# ---- per-file figures -----------------------------------------------------------------------

_DUPLICATE_WORDS = {
    "cm": "duplicate rows",
    "idx": "duplicate index rows",
    "fo": "duplicate FO rows",
    "deliv": "duplicate deliverable rows",
}


def file_counts(typed: DataFrame, product: str) -> DataFrame:
    """Rows read, undated and blank, per file; combined on the map side."""
    blank = dated(product) & expires(product) & (F.length(identifier_column(product)) == 0)
    return typed.groupBy("file_date").agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(~dated(product)).alias("n_undated"),
        F.count_if(blank).alias("n_blank"),
    )


def copy_counts(copies: DataFrame) -> DataFrame:
    """Rows kept and dropped as duplicates, per file, from the `n_copies` of each key."""
    return copies.groupBy("file_date").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(F.col("n_copies") - 1).alias("n_duplicates"),
    )


def count_issues(counts: DataFrame, product: str) -> DataFrame:
    """Issues reported once per file, from whichever of the counts above are present."""
    found = []
    if product == "fo" and "n_undated" in counts.columns:
        message = F.concat(F.col("n_undated").cast("string"), F.lit(" rows with unresolvable date"))
        found.append(F.when(F.col("n_undated") > 0, _issue("BAD_DATE", message)))
    if "n_blank" in counts.columns:
        message = F.lit("empty index name" if product == "idx" else "empty symbol row")
        found.append(F.when(F.col("n_blank") > 0, _issue("EMPTY_SYMBOL", message)))
    if "n_duplicates" in counts.columns:
        message = F.concat(
            F.lit("dropped "), F.col("n_duplicates").cast("string"),
            F.lit(" " + _DUPLICATE_WORDS[product]),
        )
        found.append(F.when(F.col("n_duplicates") > 0, _issue("DUPLICATE_ROWS", message)))
    return (
        counts.select("file_date", F.explode(F.array_compact(F.array(*found))).alias("issue"))
        .select("file_date", "issue.*")
    )
