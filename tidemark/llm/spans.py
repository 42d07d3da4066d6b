"""Matches of a pattern with their places, in DataFrame functions only.

Each match is put between two control characters, and the text is split at them: pieces with an odd index are the
matches, and the lengths of the pieces before one give its start. Texts that hold those characters themselves get
a third one in their place first, which no pattern here matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPEN, _CLOSE, _OTHER = "\x01", "\x02", "\x03"
#: Stand for characters or places that a pattern needs told apart; see plain().
MARK, MARK_2 = "\x04", "\x05"
_BLOCK = 64
CONTEXT = 24
SPAN = "array<struct<start:int,stop:int,match:string,before:string,after:string>>"


def plain(text: Column) -> Column:
    """The text without the characters that mark matches; null counts as empty. Lengths stay."""
    whole = F.coalesce(text, F.lit(""))
    held = F.regexp_like(whole, F.lit(f"[{_OPEN}{_CLOSE}{MARK}{MARK_2}]"))
    return F.when(held, F.translate(whole, _OPEN + _CLOSE + MARK + MARK_2, _OTHER * 4)).otherwise(whole)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0), lambda total, n: total + n)


def with_spans(df: DataFrame, marks: dict[str, tuple[Column, str]], least: int, unseen: str = "") -> DataFrame:
    """df with an array of spans for each name of marks: (text as made by plain(), pattern).

    A span has start and stop in code points, the match, 24 characters before it and one after it, with runs of blanks
    before it as one. They come from the text, whatever matches lie there. least: characters of the shortest match,
    from which follows how many pieces are sure to hold them. Sums of lengths are kept for blocks of 64 pieces, so the
    cost of m matches is about m * (64 + m / 64).

    Characters in unseen were put into the text for the pattern and count nowhere but in the match.
    """
    back = 2 * -(-CONTEXT // least)
    seen = (lambda piece: F.translate(piece, unseen, "")) if unseen else (lambda piece: piece)
    tmp = {name: f"__tm_{name}" for name in marks}

    def add(columns: dict[str, Column]) -> None:
        nonlocal df
        df = df.withColumns(columns)

    add({f"{t}_p": F.split(F.regexp_replace(marks[n][0], marks[n][1], f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]") for n, t in tmp.items()})
    has = {t: F.size(f"{t}_p") > 1 for t in tmp.values()}
    add({f"{t}_n": F.when(has[t], F.transform(f"{t}_p", lambda piece: F.length(seen(piece)))) for t in tmp.values()})
    add({f"{t}_e": F.when(has[t], F.transform(f"{t}_p", lambda piece: F.right(F.regexp_replace(seen(piece), "[ \\t]{2,}", " "), F.lit(CONTEXT)))) for t in tmp.values()})

    def block_sum(t: str):
        return lambda b: _sum(F.slice(f"{t}_n", b * _BLOCK + 1, _BLOCK))

    def blocks_before(t: str):
        return lambda _, b: _sum(F.slice(f"{t}_b", F.lit(1), b))

    last_block = {t: F.floor((F.size(f"{t}_n") - 1) / _BLOCK).cast("int") for t in tmp.values()}
    add({f"{t}_b": F.when(has[t], F.transform(F.sequence(F.lit(0), last_block[t]), block_sum(t))) for t in tmp.values()})
    add({f"{t}_s": F.when(has[t], F.transform(f"{t}_b", blocks_before(t))) for t in tmp.values()})

    def span(t: str):
        return lambda k: _span(t, k)

    def before(t: str, k: Column) -> Column:
        return F.right(F.concat(*(F.coalesce(F.get(f"{t}_e", k - j), F.lit("")) for j in range(back, 0, -1))), F.lit(CONTEXT))

    def after(t: str, k: Column) -> Column:
        follows = F.left(F.get(f"{t}_p", k + 1), F.lit(1))
        return F.left(F.concat(follows, F.coalesce(F.left(seen(F.get(f"{t}_p", k + 2)), F.lit(1)), F.lit(""))), F.lit(1))

    def _span(t: str, k: Column) -> Column:
        block = F.floor(k / _BLOCK).cast("int")
        start = F.get(f"{t}_s", block) + _sum(F.slice(f"{t}_n", block * _BLOCK + 1, k % _BLOCK))
        match = F.get(f"{t}_p", k)
        return F.struct(
            start.alias("start"),
            (start + F.get(f"{t}_n", k)).alias("stop"),
            match.alias("match"),
            before(t, k).alias("before"),
            after(t, k).alias("after"),
        )

    add({n: F.coalesce(F.when(has[t], F.transform(F.sequence(F.lit(1), F.size(f"{t}_p") - 2, F.lit(2)), span(t))), F.array().cast(SPAN)) for n, t in tmp.items()})
    return df.drop(*(f"{t}_{x}" for t in tmp.values() for x in "pnbse"))
