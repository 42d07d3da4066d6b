"""ANSI-safe column expressions: ratios, rates, date shifts, text normalisers, checked narrowing."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Texts that mean NULL in CASE builders.
NULL_TOKENS = ("NONE", "NULL", "NA", "N/A", "NAN")

# Letters with marks and the plain letters they become, and two letters that become two.
ACCENTED = "áéíóúñãõçàèìòùâêîôûëïüäöøåāēīōūẽĩũ"
UNACCENTED = "aeiounaocaeiouaeioueiuaooaaeioueiu"
LIGATURES = {"æ": "ae", "œ": "oe"}
# Characters that become an underscore, in the full and in the plain normaliser.
PUNCTUATION = r"[\[\]()* :.;<?/,'_&-]"
PLAIN_PUNCTUATION = r"[ \t\n\r\x0b\x0c\u00a0\u00ad\x1a\u0090()\[\]{},:.;¿?¡!´`'‘/\\<>=+°³$¥çžæ^§&#%•š·‰©ª-]"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(top: str | Column, bottom: str | Column, digits: int | None = 4, scale: float = 1, otherwise: float | None = None) -> Column:
    """top / bottom * scale, rounded; `otherwise` where the bottom is zero or null."""
    top, bottom = as_column(top), as_column(bottom)
    value = top / F.when(bottom != 0, bottom)
    value = value * scale if scale != 1 else value
    value = F.round(value, digits) if digits is not None else value
    return F.coalesce(value, F.lit(otherwise)) if otherwise is not None else value


def rate_of_change(now: Column, before: Column, digits: int | None = 4) -> Column:
    """(now - before) / before; null where before is zero or null."""
    return ratio(now - before, before, digits)


def relative_difference(source: Column, target: Column) -> Column:
    """abs(source - target) / target; null where the target is zero or null."""
    return ratio(F.abs(source - target), target, digits=None)


def month_start(day: Column, months: int = 0) -> Column:
    """The first of the month, some months on."""
    return F.add_months(F.trunc(day, "month"), months)


def shift_date(day: str | Column, fmt: str | None = None, days: int = 0, months: int = 0, years: int = 0, floor: bool = False) -> Column:
    """A date shifted by days, then months and years; with floor and no days it is first moved to the start of its month."""
    parsed = F.to_date(as_column(day), fmt) if fmt else F.to_date(as_column(day))
    if days:
        parsed = F.date_add(parsed, days)
    elif floor:
        parsed = F.trunc(parsed, "month")
    return F.add_months(parsed, months + 12 * years)


def half_month(code: str | Column) -> Column:
    """The date of a `yyyy-MM-q1` or `yyyy-MM-q2` code: the 1st or the 16th."""
    text = F.lower(as_column(code))
    return F.try_to_date(F.regexp_replace(F.regexp_replace(text, "q1$", "01"), "q2$", "16"), "yyyy-MM-dd")


def year_only(year: str | Column) -> Column:
    """The 1st of December of a year."""
    return F.make_date(as_column(year).cast("int"), F.lit(12), F.lit(1))


def _underscored(text: Column, punctuation: str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, punctuation, "_"), "_+", "_"), "^_+|_+$", "")


def normalized_text(text: str | Column) -> Column:
    """Lower case, without accents, trimmed, punctuation as single underscores, none at the ends."""
    out = F.translate(F.lower(as_column(text)), ACCENTED, UNACCENTED)
    for mark, letters in LIGATURES.items():
        out = F.replace(out, F.lit(mark), F.lit(letters))
    return _underscored(F.trim(out), PUNCTUATION)


def plain_text(text: str | Column) -> Column:
    """Punctuation and some letters as single underscores, none at the ends; case and accents stay."""
    return _underscored(as_column(text), PLAIN_PUNCTUATION)


def is_null_token(text: str) -> bool:
    return text.strip().strip("'\"").upper() in NULL_TOKENS


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions) if conditions else F.lit(True)


def trailing(partition: list[str], order: list[str | Column], rows: int) -> WindowSpec:
    """The last `rows` rows up to the current one."""
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(1 - rows, 0)


def trailing_months(partition: list[str], day: str, months: int) -> WindowSpec:
    """The calendar months up to the current one, whether or not each has a row."""
    index = F.year(day) * 12 + F.month(day)
    return Window.partitionBy(*partition).orderBy(index).rangeBetween(1 - months, 0)


def checked_int(value: Column) -> Column:
    """A bigint as int; null where it doesn't fit, never an overflow error."""
    return value.try_cast("int")
