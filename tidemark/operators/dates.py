"""Date columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import month_start, shift_date
from tidemark.operators import as_list, require


def shifted(df: DataFrame, new_column_name: str, column: str, fmt: str | None = None, days: int = 0, months: int = 0, years: int = 0, floor: bool = False) -> DataFrame:
    """A date column moved by days, months and years; see shift_date()."""
    require(df, [column])
    return df.withColumn(new_column_name, shift_date(column, fmt, days, months, years, floor))


def subtracted(df: DataFrame, new_column_name: str, column: str, days: int = 0, months: int = 0, years: int = 0) -> DataFrame:
    return shifted(df, new_column_name, column, days=-days, months=-months, years=-years)


def _side(df: DataFrame, name: str, as_of: str | None) -> Column:
    if name == "current_date":
        return F.lit(as_of).cast("date") if as_of else F.current_date()
    require(df, [name])
    return F.col(name)


def difference(df: DataFrame, new_column_name: str, date1: str, date2: str, unit: str = "day", as_of: str | None = None) -> DataFrame:
    """date1 - date2 in days or, with fractions, months; a side named current_date is as_of, or today without it."""
    first, second = _side(df, date1, as_of), _side(df, date2, as_of)
    if unit not in ("day", "month"):
        raise ValueError(f"unit {unit!r} is neither day nor month")
    return df.withColumn(new_column_name, F.datediff(first, second) if unit == "day" else F.months_between(first, second, roundOff=False))


def months_apart(df: DataFrame, new_column_name: str, date1: str, date2: str) -> DataFrame:
    return difference(df, new_column_name, date1, date2, "month")


def days_since(df: DataFrame, new_column_name: str, column: str, as_of: str | None = None) -> DataFrame:
    return difference(df, new_column_name, "current_date", column, "day", as_of)


def year_month(df: DataFrame, new_column_name: str, year: str, month: str) -> DataFrame:
    """The first day of a year and month held in two columns, which stay as they are."""
    require(df, [year, month])
    return df.withColumn(new_column_name, F.make_date(F.col(year).cast("int"), F.col(month).cast("int"), F.lit(1)))


def month_codes(df: DataFrame, columns: Mapping[str, str] | Sequence[str] | None) -> DataFrame:
    """monthyear_<column> as yyyyMM text, for columns or {column: format}; without any df is unchanged."""
    if not columns:
        return df
    formats = dict(columns) if isinstance(columns, Mapping) else dict.fromkeys(as_list(columns))
    require(df, formats)
    parsed = {c: F.to_date(F.col(c), fmt) if fmt else F.to_date(F.col(c)) for c, fmt in formats.items()}
    return df.withColumns({f"monthyear_{c}": F.date_format(day, "yyyyMM") for c, day in parsed.items()})


def whole_months(df: DataFrame, new_column_name: str, later: str, earlier: str) -> DataFrame:
    """Months between two dates, truncated to whole ones."""
    require(df, [later, earlier])
    return df.withColumn(new_column_name, F.months_between(F.col(later), F.col(earlier)).cast("int"))


def tenure(df: DataFrame, new_column_name: str, release: str, created: str) -> DataFrame:
    """Months from the start of the month of creation to the release date."""
    require(df, [release, created])
    return df.withColumn(new_column_name, F.months_between(F.col(release), month_start(F.col(created))))


def month_calendar(spark: SparkSession, start: str, end: str, name: str = "release_dt") -> DataFrame:
    """The first day of each month from start to end, each once."""
    days = F.sequence(F.trunc(F.lit(start).cast("date"), "month"), F.trunc(F.lit(end).cast("date"), "month"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(days).alias(name))


def expand_months(df: DataFrame, since: str, start: str, end: str, name: str = "release_dt") -> DataFrame:
    """A row for each month start in the range that isn't before the row's date; no join is involved."""
    require(df, [since])
    day = F.col(since).cast("date")
    first = F.trunc(day, "month")
    open_month = F.when(day == first, first).otherwise(F.add_months(first, 1))
    low, high = F.trunc(F.lit(start).cast("date"), "month"), F.trunc(F.lit(end).cast("date"), "month")
    begin = F.greatest(low, open_month)
    return df.where(day.isNotNull() & (begin <= high)).withColumn(name, F.explode(F.sequence(begin, high, F.expr("interval 1 month"))))


def with_calendar(df: DataFrame, calendar: DataFrame, id_date: str, calendar_id: str, calendar_date: str, new_column_name: str = "event_dt") -> DataFrame:
    """The date of a date id, from a calendar dimension; rows without one go. The optimizer picks the join by size."""
    if not id_date or not calendar_id:
        raise ValueError("id_date and calendar_id are needed")
    require(df, [id_date])
    require(calendar, [calendar_id, calendar_date])
    days = calendar.select(F.col(calendar_id).alias("__id"), F.col(calendar_date).alias(new_column_name))
    return df.join(days, F.col(id_date) == F.col("__id")).drop("__id")
