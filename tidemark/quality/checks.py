"""Freshness, missing columns and counts against what is saved; each check is one aggregate or one join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import half_month, year_only
from tidemark.operators import require
from tidemark.operators.aggregation import count_by_month
from tidemark.operators.joins import reconcile


class StaleDataError(ValueError):
    """Some tables are out of date."""


def parsed_date(column: str, fmt: str | None = None) -> Column:
    """A date column by format; `yyyy` and `yyyy-mm-qq` are the year-only and half-month codes."""
    if fmt == "yyyy-mm-qq":
        return half_month(column)
    if fmt == "yyyy":
        return year_only(F.col(column).cast("string").try_cast("int"))
    return F.try_to_date(F.col(column).cast("string"), fmt) if fmt else F.to_date(column)


def history_key(config: Mapping[str, Any]) -> tuple[str, str]:
    """The name and format of the history column, with defaults."""
    key = config.get("date_col_filter") or {}
    return key.get("name") or "event_dt", key.get("format") or "yyyy-MM-dd"


def freshness(df: DataFrame, table: str, column: str, as_of: str, shift_months: int = 0, fmt: str | None = None) -> DataFrame:
    """One row: table, last_date, available (last_date and the months until data can be used), outdated, months_behind.

    Outdated means available before the first of as_of's month; without any date a table is outdated.
    """
    require(df, [column])
    first = F.trunc(F.lit(as_of).cast("date"), "month")
    last = df.agg(F.max(parsed_date(column, fmt)).alias("last_date"))
    available = F.add_months("last_date", shift_months)
    behind = F.floor(F.months_between(first, F.trunc("available", "month"))).cast("int")
    return last.select(F.lit(table).alias("table"), "last_date", available.alias("available")).select(
        "*", F.coalesce(F.col("available") < first, F.lit(True)).alias("outdated"), F.when(F.col("available") < first, behind).otherwise(F.when(F.col("available").isNotNull(), 0)).alias("months_behind")
    )


def require_fresh(results: DataFrame) -> None:
    """StaleDataError that names every outdated table; results has a row for each table."""
    stale = results.where("outdated").collect()
    if stale:
        raise StaleDataError("; ".join(f"{r['table']} ends at {r['last_date']}, {r['months_behind']} months behind" for r in stale))


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def monthly_values(df: DataFrame, column: str) -> DataFrame:
    """One row: months, and months without rows between the first and the last."""
    counted = count_by_month(df, column)
    span = F.months_between(F.max("month"), F.min("month")).cast("bigint") + 1
    return counted.where("month is not null").agg(F.count("*").alias("months"), (span - F.count("*")).alias("gaps"))


def cross_check_history(source: DataFrame, saved: DataFrame, column: str, start: str | None = None) -> DataFrame:
    """Months whose counts differ between source and saved data, up to the newest saved date: expected to be none."""
    require(source, [column])
    require(saved, [column])
    day = F.to_date(column)
    within = source.where(day <= saved.agg(F.max(day)).scalar())
    if start:
        within, saved = (df.where(day >= F.lit(start).cast("date")) for df in (within, saved))
    return reconcile(count_by_month(within, column), count_by_month(saved, column), "month", "n").where("diff != 0")


def cross_check_size(source: DataFrame, saved: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """One row: both counts, their relative difference and whether it is within tolerance; an empty saved table isn't unless both are."""
    counts = source.agg(F.count("*").alias("source_n")).crossJoin(saved.agg(F.count("*").alias("target_n")))
    relative = F.abs(F.col("source_n") - F.col("target_n")) / F.when(F.col("target_n") != 0, F.col("target_n"))
    return counts.select("*", relative.alias("rel_diff")).select("*", F.coalesce(F.col("rel_diff") <= tolerance, F.col("source_n") == F.col("target_n")).alias("ok"))


@dataclass
class Verdict:
    """Outcome of validate(): what failed, with details, and what of it was to be ignored."""

    failed: dict[str, Any] = field(default_factory=dict)
    ignored: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not [name for name in self.failed if name not in self.ignored]

    @property
    def state(self) -> str:
        return "OK" if self.ok else "FAILED"


#: The layer that has to be saved before a layer is, by the ledger.
BEFORE = {"preprocessing": "ingestion", "feature": "preprocessing"}

#: The checks of each layer, in order.
CHECKS = {
    "ingestion": ["MISSING_COLUMNS", "MONTHLY_VAL", "CROSS_CHECKING", "OUTDATENESS"],
    "preprocessing": ["INGESTION_SAVED", "OUTDATENESS"],
    "feature": ["PREPROCESSING_SAVED", "OUTDATENESS"],
}


def validate(
    df: DataFrame,
    table: str,
    layer: str,
    column: str | None,
    as_of: str,
    saved: DataFrame | None = None,
    expected: Sequence[str] = (),
    shift_months: int = 0,
    fmt: str | None = None,
    ignore: Sequence[str] = (),
    tolerance: float = 0.05,
    before: Mapping[str, Any] | None = None,
) -> Verdict:
    """The layer's checks. Without a date column a table is dimensional: sizes are compared and freshness is left out.

    Without saved data there is nothing to cross-check. before is the newest ledger row of the layer before; without
    one, or where it let nothing through, the check that it was saved fails. Ledger.validate() looks it up. The actions
    here are one small aggregate for each check.
    """
    if layer not in CHECKS:
        raise ValueError(f"unknown layer {layer!r}")
    verdict = Verdict(ignored=list(ignore))
    for check in CHECKS[layer]:
        if check == "MISSING_COLUMNS" and (gone := missing_columns(df, expected)):
            verdict.failed[check] = gone
        elif check == "MONTHLY_VAL" and column and (gaps := monthly_values(df, column).first()["gaps"]):
            verdict.failed[check] = gaps
        elif check == "CROSS_CHECKING" and saved is not None:
            if column:
                if off := [r.asDict() for r in cross_check_history(df, saved, column).orderBy("month").collect()]:
                    verdict.failed[check] = [{**r, "month": str(r["month"])} for r in off]
            elif not (row := cross_check_size(df, saved, tolerance).first())["ok"]:
                verdict.failed[check] = row.asDict()
        elif check.endswith("_SAVED") and (before is None or before["state"] != "OK"):
            verdict.failed[check] = "not found in the ledger" if before is None else f"didn't pass: {before['reason']}"
        elif check == "OUTDATENESS" and column:
            row = freshness(df, table, column, as_of, shift_months, fmt).first()
            if row["outdated"]:
                verdict.failed[check] = {"last_date": str(row["last_date"]), "months_behind": row["months_behind"]}
    return verdict
