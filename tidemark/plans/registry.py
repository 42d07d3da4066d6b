"""Registration of queries together with the SQL that states them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Registers a query under its function's name; sql is DuckDB SQL for its rows, None where SQL can't state them."""

    def register(function: Query) -> Query:
        if function.__name__ in QUERIES:
            raise ValueError(f"query {function.__name__} exists")
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
