"""Filtered, sorted exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.model import EXPORTABLE, TABLES

FORMATS = ("parquet", "csv")


def export_rows(
    tables: Mapping[str, DataFrame],
    table: str,
    *,
    symbols: Sequence[str] | None = None,
    indexes: Sequence[str] | None = None,
    series: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Rows of a table under the filters that apply to it, sorted by its first two columns, then by the rest of
    its key: rows of one frequent pair are then split over tasks, too.

    Names match exactly; stored index names are upper case. `symbols` and `indexes` both
    constrain the index table.
    """
    if table not in EXPORTABLE:
        raise ValueError(f"unknown export table {table!r}; must be one of {sorted(EXPORTABLE)}")
    df = tables[table]
    name = TABLES[table].symbol
    if symbols and name:
        df = df.where(F.col(name).isin(list(symbols)))
    if indexes and name == "index_name":
        df = df.where(F.col(name).isin(list(indexes)))
    if series and table == "bhav_daily":
        df = df.where(F.col("series") == series)
    if table != "equity_master":
        if start:
            df = df.where(F.col("date") >= F.lit(start))
        if end:
            df = df.where(F.col("date") <= F.lit(end))
    order = list(dict.fromkeys([*TABLES[table].columns[:2], *TABLES[table].key]))
    return df.orderBy(*[F.asc_nulls_last(c) for c in order])


def export_table(
    tables: Mapping[str, DataFrame],
    table: str,
    out: str,
    *,
    fmt: str = "parquet",
    single_file: bool = False,
    **filters,
) -> str:
    """Write an export to the folder `out`, as parts in sort order; returns `out`.

    `single_file` writes one part, for small results only.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be parquet|csv, got {fmt!r}")
    df = export_rows(tables, table, **filters)
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # text comes out as stored: no trimming, doubled quotes
        writer.option("header", True).option("escape", '"').option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(out)
    else:
        writer.parquet(out)
    return out
