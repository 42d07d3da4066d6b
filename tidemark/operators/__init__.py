"""Lazy operators (DataFrame, params) -> DataFrame: they check schemas only and start no job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require(df: DataFrame, columns: Iterable[str]) -> None:
    """KeyError for columns that df doesn't have."""
    if missing := [c for c in columns if c not in df.columns]:
        raise KeyError(f"no such columns: {missing}; there are {df.columns}")


def as_list(columns: str | Iterable[str] | None) -> list[str]:
    return [] if columns is None else [columns] if isinstance(columns, str) else list(columns)
