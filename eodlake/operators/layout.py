"""Header matching, done once per file layout while the plan is built.

Files of one layout share one scan whose columns are the verbatim headers, so matching costs
nothing per row and Spark reads only the columns that are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.functions.text import col
from eodlake.model import LAKH, PRODUCTS, Product


@dataclass(frozen=True)
class Layout:
    product: Product
    source: dict[str, str]  # table column -> verbatim header
    in_lakhs: bool

    def has(self, column: str) -> bool:
        return column in self.source

    def text(self, column: str) -> Column:
        """The raw text of a table column, null if this layout lacks it."""
        if column in self.source:
            return col(self.source[column])
        return F.lit(None).cast("string")

    def scale(self, column: str, value: Column) -> Column:
        """Rupees from lakhs, if the header says lakhs."""
        if self.in_lakhs and self.product.scaled[0] == column:
            return value * LAKH
        return value


def match_headers(product: str, headers: list[str]) -> Layout:
    """Known headers -> table columns; raises ValueError if the file cannot be used.

    A repeated identical header keeps its first column; two different headers for the same table
    column are an error, as is a missing required one.
    """
    spec = PRODUCTS[product]
    by_header = {h: c for c, names in spec.headers.items() for h in names}
    source: dict[str, str] = {}
    for header in headers:
        column = by_header.get(header.strip().upper())
        if column is None or source.get(column) == header:
            continue
        if column in source:
            raise ValueError(f"headers {source[column]!r} and {header!r} both give {column!r}")
        source[column] = header
    missing = [c for c in spec.required if c not in source]
    if missing:
        raise ValueError(f"file missing required columns: {missing} (got {sorted(source)})")
    in_lakhs = spec.scaled is not None and (
        source.get(spec.scaled[0], "").strip().upper() == spec.scaled[1]
    )
    return Layout(spec, source, in_lakhs)


def normalize_headers(raw: DataFrame, product: str) -> DataFrame:
    """Raw frame under table column names, unknown columns dropped, all still text."""
    layout = match_headers(product, raw.columns)
    keep = [c for c in ("file_date", "row_no") if c in raw.columns]
    return raw.select(
        *keep, *[layout.text(c).alias(c) for c in layout.product.headers if layout.has(c)]
    )
