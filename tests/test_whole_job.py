"""Queries work on all rows of their tables: against brute force on small tables."""

import datetime as dt

import __spark_entry__ as entry
from tidemark.quality import checks


def test_calendar_expansion_takes_every_order(spark, tmp_path):
    days = [dt.date(1994, 5, 7), dt.date(1996, 3, 1), dt.date(1996, 3, 2), dt.date(2001, 12, 31), dt.date(2002, 1, 2)]
    orders = [(10 * c + k, c, day) for c in (1, 199, 200, 70_000) for k, day in enumerate(days)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted(map(tuple, entry.queries()["j05_calendar_expansion"](spark, str(tmp_path)).collect()))
    months = [dt.date(1995 + k // 12, k % 12 + 1, 1) for k in range(85)]
    assert got == sorted((key, month) for key, _, day in orders for month in months if month >= day)


def test_cross_checking_names_every_differing_month(spark):
    months = spark.createDataFrame([(dt.date(2000 + k // 12, k % 12 + 1, 1),) for k in range(150)], "d date")
    verdict = checks.validate(months.union(months), "t", "ingestion", "d", "2012-07-02", months)
    assert [row["month"][:7] for row in verdict.failed["CROSS_CHECKING"]] == [f"{2000 + k // 12}-{k % 12 + 1:02}" for k in range(150)]
