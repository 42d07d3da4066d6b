"""Row filters; none of them starts a job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import all_of
from tidemark.operators import require


def filter_by_conditions(df: DataFrame, conditions: Sequence[str] | None) -> DataFrame:
    """Rows for which all SQL conditions hold; without any, df itself."""
    return df.where(all_of([F.expr(c) for c in conditions])) if conditions else df


def filter_named_frames(parameters: Mapping[str, Mapping], **frames: DataFrame) -> dict[str, DataFrame]:
    """Each frame filtered by the conditions under its name; frames without any pass."""
    return {name: filter_by_conditions(df, (parameters.get(name) or {}).get("conditions")) for name, df in frames.items()}


def filter_max(df: DataFrame, column: str) -> DataFrame:
    """Rows with the column's largest value, by a join with a one-row aggregate; empty where all are null."""
    require(df, [column])
    top = df.agg(F.max(column).alias("__top"))
    return df.join(F.broadcast(top), df[column] == top["__top"], "left_semi")


def exclude_sentinel(df: DataFrame, column: str, sentinel: str = "999999999", not_null: Sequence[str] = ()) -> DataFrame:
    """Rows whose id is neither null nor the sentinel, compared as text, and whose measures aren't null."""
    require(df, [column, *not_null])
    kept = F.col(column).isNotNull() & (F.col(column).cast("string") != sentinel)
    return df.where(all_of([kept, *(F.col(c).isNotNull() for c in not_null)]))


def filter_dates(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of a closed date range; an absent bound doesn't bind."""
    require(df, [column])
    bounds = ([F.col(column) >= F.lit(start).cast("date")] if start else []) + ([F.col(column) <= F.lit(end).cast("date")] if end else [])
    return df.where(all_of(bounds)) if bounds else df


def latest(df: DataFrame, order: str, conditions: Sequence[str] | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row that meets the conditions."""
    return filter_by_conditions(df, conditions).orderBy(F.desc(order), *tiebreak).limit(1)
