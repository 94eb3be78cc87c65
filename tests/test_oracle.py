"""Every registered query against its SQL on the smallest folder."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from eodlake.fixtures.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return repr(round(float(value), 9))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def sorted_rows(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
