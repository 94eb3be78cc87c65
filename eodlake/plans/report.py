"""Data-quality report: coverage, gaps, anomalies, master drift and side tables.

A report is a set of DataFrames. Its Markdown and JSON forms are DataFrames too, one text line per
row, so a long list of symbols is written by Spark and never gathered in one place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.functions.calendar import month_bounds
from eodlake.operators import anomalies, coverage
from eodlake.operators.store import Store
from eodlake.session import Scratch

MAX_LISTED = 50
FIRST_DAY = dt.date(2000, 1, 1)
GAP_KINDS = ("missing_attempt", "ingest_error", "unknown_holiday")
LINE_ORDER = ("section", "ord", "line")


@dataclass(frozen=True)
class Report:
    product: str
    generated_at: str
    start: dt.date
    end: dt.date
    coverage: DataFrame
    gaps: DataFrame
    counts: DataFrame
    samples: DataFrame
    drift: DataFrame
    cross: DataFrame


def report_range(
    log: DataFrame,
    product: str,
    month: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    today: dt.date | None = None,
) -> tuple[dt.date, dt.date]:
    """A month, else the given bounds, else what the log covers, else the last 366 days."""
    today = today or dt.date.today()
    if month:
        return month_bounds(month)
    if start or end:
        low, high = start or FIRST_DAY, end or today
    else:
        row = coverage.log_range(log.where(F.col("product") == product)).first()
        low = row["first"] if row else today - dt.timedelta(days=366)
        high = row["last"] if row else today
    if low > high:
        raise ValueError(f"range start {low} is after end {high}")
    return low, high


def build_report(
    tables: Mapping[str, DataFrame],
    product: str,
    start: dt.date,
    end: dt.date,
    generated_at: str | None = None,
    scratch: Scratch | None = None,
) -> Report:
    """The parts of a report; with `scratch`, anomalies are found once for their counts and samples."""
    log = tables["ingest_log"].where(F.col("product") == product)
    found = anomalies.anomalies(tables, start, end)
    if scratch is not None:
        found = scratch.write(found)
    return Report(
        product,
        generated_at or dt.datetime.now().isoformat(timespec="seconds"),
        start,
        end,
        coverage.month_coverage(log, [product], start, end),
        coverage.detect_gaps(log, [product], start, end),
        anomalies.anomaly_counts(found),
        anomalies.anomaly_samples(found),
        anomalies.master_drift(tables["bhav_daily"], tables["equity_master"]),
        coverage.cross_tables(tables, start, end),
    )


def materialized(report: Report, scratch: Scratch) -> Report:
    """The same report with each part computed once; every part is small but the drift list."""
    parts = ("coverage", "gaps", "counts", "samples", "drift", "cross")
    return replace(report, **{p: scratch.write(getattr(report, p)) for p in parts})


def report_gap_rows(report: Report) -> DataFrame:
    return coverage.gap_rows(report.gaps, report.drift, [report.product], report.end)


# ---- shared pieces --------------------------------------------------------------------------

def _gap_dates(report: Report) -> DataFrame:
    """One row with the sorted dates of each gap kind: bounded by the calendar."""
    return report.gaps.agg(
        *[
            F.sort_array(
                F.collect_list(F.when(F.col("gap_type") == k, F.col("date").cast("string")))
            ).alias(k)
            for k in GAP_KINDS
        ]
    )


def _codes_with_samples(report: Report) -> DataFrame:
    """(code_no, code, count, samples): at most a handful of samples per code."""
    samples = report.samples.groupBy("code").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("ord", "sample"))), lambda x: x["sample"]
        ).alias("samples")
    )
    return report.counts.join(samples, "code", "left")


def _lines(df: DataFrame, section: int, order: Column, lines: Column) -> DataFrame:
    """Explode an array of text lines; nulls in it are left out."""
    return df.select(
        F.lit(section).alias("section"), order.cast("bigint").alias("_base"),
        F.posexplode(F.array_compact(lines)).alias("_pos", "line"),
    ).select(
        "section", (F.col("_base") * 1000 + F.col("_pos")).alias("ord"), "line"
    )


def _text(value: str) -> Column:
    return F.lit(value)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- Markdown -------------------------------------------------------------------------------

def report_lines(report: Report) -> DataFrame:
    """(section, ord, line) of the Markdown report."""
    one = report.coverage.sparkSession.range(1)
    dates = _gap_dates(report)
    n = {k: F.size(k).cast("string") for k in GAP_KINDS}
    head = _lines(dates, 1, F.lit(0), F.array(
        _text(f"# data-quality report — {report.product}"),
        _text(""),
        _text(f"- generated: {report.generated_at}"),
        _text(f"- range: {report.start} .. {report.end}"),
        F.concat(
            _text("- gaps: "), n["missing_attempt"], _text(" missing, "), n["ingest_error"],
            _text(" errors, "), n["unknown_holiday"], _text(" unknown holidays"),
        ),
        _text(""),
        _text("## Monthly coverage"),
        _text(""),
        _text("| month | expected | data days | holidays | errors | coverage |"),
        _text("| ------ | -------: | --------: | -------: | -----: | -------: |"),
    ))
    month_no = F.regexp_replace("month", "-", "").cast("bigint")
    months = _lines(report.coverage, 2, month_no, F.array(F.concat(
        _text("| "),
        F.concat_ws(" | ", "month", "expected", "data_days", "holidays", "errors", "coverage_pct"),
        _text("% |"),
    )))

    def listed(kind: str, title: str, shown: Column) -> list[Column]:
        some = F.size(kind) > 0
        return [
            F.when(some, title),
            F.when(some, F.concat(_text(" - "), F.array_join(shown, ", "))),
            F.when(some, ""),
        ]

    gaps = _lines(dates, 3, F.lit(0), F.array(
        _text(""), _text("## Gaps"), _text(""),
        *listed(
            "missing_attempt", "Missing attempts (weekdays with no record):",
            F.slice("missing_attempt", 1, MAX_LISTED),
        ),
        *listed("ingest_error", "Ingest errors:", F.col("ingest_error")),
        *listed(
            "unknown_holiday", "Unknown holidays detected by source (add to the calendar):",
            F.col("unknown_holiday"),
        ),
        _text("## Anomalies"), _text(""),
    ))

    def cells(values: Column) -> Column:
        return F.concat(_text("| "), F.array_join(values, " | "), _text(" |"))

    first = F.get("samples", F.lit(0))
    some = F.size("samples") > 0
    codes = _lines(_codes_with_samples(report), 4, F.col("code_no"), F.concat(
        F.array(
            F.concat("code", _text(" ("), F.col("count").cast("string"), _text(")")),
            F.when(some, ""),
            F.when(some, cells(F.transform(first, lambda c: c["name"]))),
            F.when(some, cells(F.transform(first, lambda c: _text("---")))),
        ),
        F.coalesce(
            F.transform("samples", lambda s: cells(F.transform(s, lambda c: c["value"]))),
            F.array().cast("array<string>"),
        ),
        F.array(_text("")),
    ))
    codes = codes.withColumn(
        "line",
        F.when(F.col("ord") % 1000 == 0, F.concat(_text("### "), "line")).otherwise(F.col("line")),
    )
    shown = report.drift.orderBy("symbol").limit(MAX_LISTED).agg(
        F.sort_array(F.collect_list("symbol")).alias("shown")
    )
    drift = _lines(shown, 5, F.lit(0), F.array(
        _text("## Equity master drift"), _text(""),
        F.when(
            F.size("shown") > 0,
            F.concat(
                _text("EQ symbols with bars but missing from the master: "),
                F.array_join("shown", ", "),
            ),
        ).otherwise("none"),
        _text(""), _text("## Cross-dataset coverage"), _text(""),
        _text("| table | days | rows | first | last |"),
        _text("| --- | ---: | ---: | --- | --- |"),
    ))
    table_no = F.array_position(
        F.array(*[F.lit(t) for t in coverage.SIDE_TABLES]), F.col("table")
    )
    dash = [F.coalesce(F.col(c).cast("string"), _text("-")) for c in ("first", "last")]
    cross = _lines(report.cross, 6, table_no, F.array(F.concat(
        _text("| "),
        F.concat_ws(" | ", "table", F.col("days").cast("string"), F.col("rows").cast("string"), *dash),
        _text(" |"),
    )))
    end = _lines(one, 7, F.lit(0), F.array(_text("")))
    return _union([head, months, gaps, codes, drift, cross, end])


# ---- JSON -----------------------------------------------------------------------------------

def _after_first(is_first: Column, json: Column) -> Column:
    return F.concat(F.when(is_first, "").otherwise(","), json)


def report_json(report: Report) -> DataFrame:
    """(section, ord, line) of the JSON report: joined in order, the lines are one document.

    The drift list takes one line per symbol and is sorted by Spark, whatever its length.
    """
    one = report.coverage.sparkSession.range(1)
    about = F.to_json(F.struct(
        F.lit(report.product).alias("product"),
        F.lit(report.generated_at).alias("generated_at"),
        F.lit(str(report.start)).alias("start"),
        F.lit(str(report.end)).alias("end"),
    ))

    def text_lines(df: DataFrame, section: int, key: Column, line: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), key.cast("string").alias("ord"),
                         line.alias("line"))

    none = F.lit("")
    head = text_lines(one, 1, none, F.concat(
        F.left(about, F.length(about) - 1), _text(',"coverage":[')
    ))
    months = text_lines(report.coverage, 2, F.col("month"), _after_first(
        F.col("month") == f"{report.start:%Y-%m}",
        F.to_json(F.struct(
            "product", "month", "expected", "data_days",
            F.col("holidays").alias("holidays_detected"), "errors", "coverage_pct",
        )),
    ))
    gaps = text_lines(_gap_dates(report), 3, none, F.concat(
        _text('],"gaps":'),
        F.to_json(F.struct(
            F.lit(report.product).alias("product"),
            F.lit(str(report.start)).alias("start"),
            F.lit(str(report.end)).alias("end"),
            F.col("missing_attempt").alias("missing_attempts"),
            F.col("ingest_error").alias("errors"),
            F.col("unknown_holiday").alias("unknown_holidays"),
        )),
        _text(',"anomalies":['),
    ))
    samples = F.transform(
        F.coalesce("samples", F.array().cast("array<array<struct<name:string,value:string>>>")),
        lambda s: F.map_from_entries(s),
    )
    codes = text_lines(_codes_with_samples(report), 4, F.col("code_no"), _after_first(
        F.col("code_no") == 1, F.to_json(F.struct("code", "count", samples.alias("samples")))
    ))
    drift_head = text_lines(one, 5, none, _text('],"master_drift":['))
    # sorting by symbol puts the smallest first; it alone goes without a comma
    quoted = F.to_json(F.array("symbol"))
    drift = text_lines(report.drift, 6, F.col("symbol"), _after_first(
        F.col("symbol") == report.drift.agg(F.min("symbol")).scalar(),
        F.substring(quoted, F.lit(2), F.length(quoted) - 2),
    ))
    cross_head = text_lines(one, 7, none, _text('],"cross_tables":['))
    table_no = F.array_position(
        F.array(*[F.lit(t) for t in coverage.SIDE_TABLES]), F.col("table")
    )
    cross = text_lines(report.cross, 8, table_no, _after_first(
        table_no == 1,
        F.to_json(
            F.struct("table", "days", "rows", F.col("first").cast("string").alias("first"),
                     F.col("last").cast("string").alias("last")),
            {"ignoreNullFields": "false"},
        ),
    ))
    end = text_lines(one, 9, none, _text("]}"))
    return _union([head, months, gaps, codes, drift_head, drift, cross_head, cross, end])


def write_lines(lines: DataFrame, path: str) -> None:
    """Write report lines in order, as text parts."""
    lines.orderBy("section", "ord").select("line").write.mode("overwrite").text(path)


def run_report(
    store: Store,
    product: str,
    out: str | None = None,
    *,
    month: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> dict:
    """Build a report, refresh the gap table and, if `out` is given, write Markdown and JSON.

    Returns the range, the number of gap rows and the places written.
    """
    low, high = report_range(store["ingest_log"], product, month, start, end)
    with Scratch(store.spark) as scratch:
        report = materialized(build_report(store, product, low, high, scratch=scratch), scratch)
        n = store.refresh_gaps(product, report_gap_rows(report))
        done = {"start": low, "end": high, "gap_rows": n}
        if out is not None:
            done["markdown"] = f"{out}/report_{product}.md"
            done["json"] = f"{out}/report_{product}.json"
            write_lines(report_lines(report), done["markdown"])
            write_lines(report_json(report), done["json"])
    return done
