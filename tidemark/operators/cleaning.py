"""Nulls, duplicates, text and column names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import normalized_text, plain_text
from tidemark.operators import as_list, require
from tidemark.operators.projection import string_columns


def standardize_na_values(df: DataFrame, tokens: Mapping[str, Sequence]) -> DataFrame:
    """Values that stand for missing ones become NULL; columns with no tokens stay."""
    require(df, tokens)
    return df.withColumns({c: F.when(~F.col(c).isin(*t) | F.col(c).isNull(), F.col(c)) for c, t in tokens.items() if t})


def _subset(df: DataFrame, subset: str | Sequence[str] | None) -> list[str] | None:
    """None for nothing, [] for all columns; a single name is one column, never its letters."""
    if not subset:
        return None
    if isinstance(subset, str) and subset.lower() == "all":
        return []
    names = as_list(subset)
    require(df, names)
    return names


def drop_na(df: DataFrame, subset: str | Sequence[str] | None) -> DataFrame:
    """Rows without a null in the subset ('all': in any column); an empty subset changes nothing."""
    names = _subset(df, subset)
    return df if names is None else df.dropna(subset=names or None)


def drop_duplicates(df: DataFrame, subset: str | Sequence[str] | None, order: Sequence | None = None) -> DataFrame:
    """One row for each value of the subset; with order the first by it, else an arbitrary one."""
    names = _subset(df, subset)
    if names is None:
        return df
    if order and names:
        by = Window.partitionBy(*names).orderBy(*order)
        return df.withColumn("__rank", F.row_number().over(by)).where("__rank = 1").drop("__rank")
    return df.dropDuplicates(names or None)


def impute(df: DataFrame, value: Any) -> DataFrame:
    """NULL as a value: one for all columns of its type, or {column: value}."""
    if isinstance(value, Mapping):
        require(df, value)
    return df.fillna(dict(value) if isinstance(value, Mapping) else value)


def _on_strings(df: DataFrame, change) -> DataFrame:
    return df.withColumns({c: change(F.col(c)) for c in string_columns(df)})


def trim_strings(df: DataFrame) -> DataFrame:
    return _on_strings(df, F.trim)


def normalize_strings(df: DataFrame) -> DataFrame:
    """Every text column trimmed and normalised: lower case, no accents, punctuation as single underscores."""
    return _on_strings(df, lambda c: normalized_text(F.trim(c)))


def plain_strings(df: DataFrame) -> DataFrame:
    """Every text column with punctuation as single underscores; case and accents stay."""
    return _on_strings(df, plain_text)


def lower_plain_strings(df: DataFrame) -> DataFrame:
    return _on_strings(df, lambda c: plain_text(F.lower(c)))


def standard_name(name: str) -> str:
    """A column name in plain lower-case letters, with underscores for punctuation and none at the end."""
    plain = unicodedata.normalize("NFKD", name.replace("@", "a")).encode("ascii", "ignore").decode()
    return re.sub(r"[^0-9A-Za-z]+", "_", plain).removesuffix("_").lower()


def standardize_column_names(df: DataFrame) -> DataFrame:
    names = [standard_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns would share names: {sorted({n for n in names if names.count(n) > 1})}")
    return df.toDF(*names)


def merge_duplicate_columns(df: DataFrame) -> DataFrame:
    """Columns of the same name as one: the first value that isn't null."""
    places: dict[str, list[int]] = {}
    for k, name in enumerate(df.columns):
        places.setdefault(name, []).append(k)
    apart = df.toDF(*(f"__{k}" for k in range(len(df.columns))))
    return apart.select(*(F.coalesce(*(F.col(f"__{k}") for k in at)).alias(name) for name, at in places.items()))
