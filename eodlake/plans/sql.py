"""Free read-only SQL over the stored tables."""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Run one query; anything but a query raises ValueError.

    The text becomes a subquery, where Spark's own grammar admits nothing but a query: no DDL, no
    SET, no INSERT behind a WITH, no second statement. The line breaks keep a trailing comment
    from swallowing the bracket.
    """
    body = text.strip().rstrip(";").rstrip()
    if not body:
        raise ValueError("empty statement")
    try:
        return spark.sql(f"SELECT * FROM (\n{body}\n)")
    except ParseException as exc:
        raise ValueError(f"only a single read-only query is allowed: {exc}") from exc
