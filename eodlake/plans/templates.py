"""The named read-only queries.

`tables` is anything that maps a table name to a DataFrame: a `Store`, or a dict in tests. Ties are
broken by the rest of the primary key, so results are the same on every run. A `Store` knows its days
from its folders: queries of the latest or the earliest days open only those. Elsewhere the latest day is
a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.functions.text import round_to

Tables = Mapping[str, DataFrame]

COUNTED = ("bhav_daily", "index_daily", "fo_daily", "deliverable_daily", "equity_master")
FUTURE = "XX"


def asc(name: str) -> Column:
    return F.asc_nulls_last(name)


def desc(name: str) -> Column:
    return F.desc_nulls_last(name)


def latest_day(rows: DataFrame) -> DataFrame:
    """Rows of the newest date, the maximum taken over the whole table."""
    return rows.where(F.col("date") == rows.agg(F.max("date")).scalar())


def latest_rows(tables: Tables, name: str) -> DataFrame:
    """Rows of the newest date of a table."""
    if not hasattr(tables, "days"):
        return latest_day(tables[name])
    for day in reversed(tables.days(name)):
        rows = tables.table(name, day, day)
        if not rows.isEmpty():  # a folder may be empty
            return rows
    return tables[name]


def earliest_rows(
    tables: Tables, names: tuple[str, ...], wanted: int, query: Callable[[Tables], DataFrame]
) -> DataFrame:
    """`query` over the tables, or over as many of their first days as hold `wanted` rows of it.

    The first `wanted` rows by date are the same. The stretch of days grows fourfold until it holds enough.
    """
    days = tables.days(names[0]) if hasattr(tables, "days") else []
    width = 1
    while width < len(days):
        found = query({n: tables.table(n, end=days[width - 1]) for n in names})
        if found.limit(wanted).count() == wanted:
            return found
        width *= 4
    return query(tables)


def latest(tables: Tables) -> DataFrame:
    return tables["bhav_daily"].agg(
        F.max("date").alias("last_trading_day"), F.count(F.lit(1)).alias("rows")
    )


def count_rows(tables: Tables, names: tuple[str, ...]) -> DataFrame:
    """(table, rows) of several tables."""
    counts = [
        tables[n].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
        for n in names
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def table_counts(tables: Tables) -> DataFrame:
    return count_rows(tables, COUNTED)


def _movers(tables: Tables) -> DataFrame:
    ratio = F.try_divide(F.col("close"), F.col("prev_close"))
    return (
        latest_rows(tables, "bhav_daily")
        .where((F.col("series") == "EQ") & (F.col("prev_close") > 0))
        .withColumn("_ratio", ratio)
        .withColumn("pct", round_to((F.col("_ratio") - 1) * 100, 2))
    )


_MOVER_COLUMNS = ("symbol", "date", "close", "prev_close", "pct")


def top_gainers(tables: Tables) -> DataFrame:
    ranked = _movers(tables).orderBy(desc("_ratio"), asc("symbol")).limit(10)
    return ranked.select(*_MOVER_COLUMNS)


def top_losers(tables: Tables) -> DataFrame:
    ranked = _movers(tables).orderBy(asc("_ratio"), asc("symbol")).limit(10)
    return ranked.select(*_MOVER_COLUMNS)


def volume_leaders(tables: Tables) -> DataFrame:
    return (
        latest_rows(tables, "bhav_daily")
        .orderBy(desc("total_traded_quantity"), asc("symbol"), asc("series"))
        .limit(10)
        .select(
            "symbol", "date", F.col("total_traded_quantity").alias("qty"),
            round_to(F.col("turnover"), 2).alias("turnover"),
        )
    )


def delivery_spike(tables: Tables) -> DataFrame:
    return (
        latest_rows(tables, "bhav_daily")
        .where((F.col("total_traded_quantity") > 0) & (F.col("delivery_pct") > 70))
        .orderBy(desc("delivery_pct"), asc("symbol"), asc("series"))
        .limit(10)
        .select(
            "symbol", "date", "delivery_qty", "total_traded_quantity",
            round_to(F.col("delivery_pct"), 2).alias("delivery_pct"),
        )
    )


def fo_most_traded(tables: Tables) -> DataFrame:
    return (
        latest_rows(tables, "fo_daily")
        .orderBy(
            desc("contracts"), asc("instrument"), asc("symbol"), asc("expiry_date"),
            asc("option_type"), asc("strike_price"),
        )
        .limit(10)
        .select(
            "instrument", "symbol", "expiry_date", "option_type", "strike_price", "contracts",
            round_to(F.col("value"), 0).alias("value"),
        )
    )


def fo_open_interest(tables: Tables) -> DataFrame:
    wanted = (F.col("symbol") == "NIFTY") & (F.col("option_type") == FUTURE)
    return (
        earliest_rows(tables, ("fo_daily",), 20, lambda t: t["fo_daily"].where(wanted))
        .orderBy(asc("date"), asc("expiry_date"), asc("instrument"), asc("strike_price"))
        .limit(20)
        .select("instrument", "symbol", "date", "open_interest")
    )


def index_history(tables: Tables) -> DataFrame:
    return (
        earliest_rows(
            tables, ("index_daily",), 30, lambda t: t["index_daily"].where(F.col("index_name") == "NIFTY 50")
        )
        .orderBy(asc("date"))
        .limit(30)
        .select("index_name", "date", "close")
    )


def delivery_ratio(tables: Tables) -> DataFrame:
    """Bars with their deliveries. The join leaves out series, so a bar meets every series."""

    def joined(tables: Tables) -> DataFrame:
        bars = tables["bhav_daily"].where(F.col("delivery_qty") > 0)
        deliveries = tables["deliverable_daily"].select(
            "symbol", "date", "delivery_quantity", F.col("series").alias("_delivered_series")
        )
        return bars.join(deliveries, ["symbol", "date"])

    return (
        earliest_rows(tables, ("bhav_daily", "deliverable_daily"), 10, joined)
        .orderBy(asc("date"), asc("symbol"), asc("series"), asc("_delivered_series"))
        .limit(10)
        .select("symbol", "date", "delivery_qty", "delivery_quantity")
    )


TEMPLATES: dict[str, Callable[[Tables], DataFrame]] = {
    "latest": latest,
    "table_counts": table_counts,
    "top_gainers": top_gainers,
    "top_losers": top_losers,
    "volume_leaders": volume_leaders,
    "delivery_spike": delivery_spike,
    "fo_most_traded": fo_most_traded,
    "fo_open_interest": fo_open_interest,
    "index_history": index_history,
    "delivery_ratio": delivery_ratio,
}


def execute_template(tables: Tables, name: str) -> DataFrame | None:
    """Run a named query; None if there is no such name."""
    template = TEMPLATES.get(name)
    return None if template is None else template(tables)
