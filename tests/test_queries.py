"""Every registered query that has SQL gives the same rows as DuckDB; the driver's contract holds."""

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


def cell(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, int | float | Decimal):
        return round(float(value), 9) + 0.0
    return value.date() if hasattr(value, "date") and callable(value.date) else value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    mine = Counter(tuple(cell(r[c]) for c in columns) for r in got.collect())
    theirs = Counter(tuple(cell(r[k]) for k in order) for r in want.fetchall())
    assert mine == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
