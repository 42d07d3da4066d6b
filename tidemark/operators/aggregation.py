"""Grouped aggregates, pivots and panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import require

#: Aggregates that parameters may name.
AGGREGATES = frozenset(
    "approx_count_distinct avg bit_and bit_or bool_and bool_or collect_list collect_set corr count count_distinct countDistinct covar_pop covar_samp every first kurtosis last max max_by mean "
    "median min min_by mode percentile_approx skewness some std stddev stddev_pop stddev_samp sum sum_distinct var_pop var_samp variance".split()
)


def aggregate(name: str, column: str | None) -> Column:
    if name.lower() not in AGGREGATES and name not in AGGREGATES:
        raise ValueError(f"aggregate {name!r} isn't allowed")
    function = getattr(F, name if hasattr(F, name) else name.lower())
    return function(F.col(column)) if column else function(F.lit(1)) if name.lower() == "count" else function()


def aggregation_operations(df: DataFrame, by_columns: Sequence[str], operations: Sequence[Mapping], pivot: str | None = None, pivot_values: Sequence | None = None, join: bool = False) -> DataFrame:
    """Aggregates by columns; with pivot one set for each of pivot_values (found by a job if not given).

    Each operation: operation, column (none: without argument), alias (none: the engine's name). With join the
    results are put beside the rows of df, whose own columns of the same names give way; rows with null keys go.
    """
    if not by_columns:
        raise ValueError("by_columns is needed")
    columns = [op["column"] for op in operations if op.get("column")]
    require(df, [*by_columns, *columns, *([pivot] if pivot else [])])
    outs = [a.alias(op["alias"]) if op.get("alias") else a for op in operations for a in [aggregate(op["operation"], op.get("column"))]]
    grouped = df.groupBy(*by_columns)
    if pivot:
        grouped = grouped.pivot(pivot, list(pivot_values)) if pivot_values else grouped.pivot(pivot)
    result = grouped.agg(*outs)
    if not join:
        return result
    fresh = [c for c in result.columns if c not in by_columns]
    return df.drop(*fresh).join(result, list(by_columns))


def panel(df: DataFrame, keys: Sequence[str], sums: Sequence[str], tops: Sequence[str] = (), count_as: str | None = None) -> DataFrame:
    """Count of rows, {column}_sum and the largest of categorical columns under their own names."""
    require(df, [*keys, *sums, *tops])
    counted = [F.count("*").alias(count_as)] if count_as else []
    return df.groupBy(*keys).agg(*counted, *(F.sum(c).alias(f"{c}_sum") for c in sums), *(F.max(c).alias(c) for c in tops))


def pivot_panel(
    df: DataFrame, keys: Sequence[str], stats: Mapping[str, Sequence[str]], pivot_column: str | None = None, pivot_sums: Mapping[str, str] | None = None, categories: Mapping[str, str] | None = None, fill: float | None = None
) -> DataFrame:
    """{column}_{stat}_m for each statistic, and for each category its sums and an indicator, in one aggregation.

    pivot_sums: {column: suffix}; categories: {value: name}. Sums over rows of other categories count them as zero,
    and ind_{name}_{pivot_column} tells whether there was any. The three pivot parameters go together.
    """
    pivot = [pivot_column, pivot_sums, categories]
    if any(pivot) and not all(pivot):
        raise ValueError("pivot_column, pivot_sums and categories go together")
    require(df, [*keys, *stats])
    outs = []
    for value, name in (categories or {}).items():
        mine = F.col(pivot_column) == value
        outs += [F.sum(F.when(mine, F.col(c)).otherwise(F.lit(0))).alias(f"{name}_{suffix}") for c, suffix in pivot_sums.items()]
        outs.append((F.sum(F.when(mine, 1).otherwise(0)) > 0).alias(f"ind_{name}_{pivot_column}"))
    outs += [aggregate(stat, c).alias(f"{c}_{stat}_m") for c, names in stats.items() for stat in names]
    result = df.groupBy(*keys).agg(*outs)
    return result.fillna(fill) if fill is not None else result


def count_by_month(df: DataFrame, column: str, name: str = "month", count_as: str = "n") -> DataFrame:
    require(df, [column])
    return df.groupBy(F.trunc(F.col(column), "month").alias(name)).agg(F.count("*").alias(count_as))
