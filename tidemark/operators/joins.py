"""Equi-joins, anti-joins, as-of joins, reconciliation and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import ratio, relative_difference
from tidemark.operators import as_list, require


def make_join(left: DataFrame, right: DataFrame, method: str, left_columns: Sequence[str], right_columns: Sequence[str], drop_na: bool = False) -> DataFrame:
    """An equi-join; right keys take the left's names, and of other columns that share a name the left's stays.

    Columns keep the order left, then right. Missing or unequal keys are a ValueError, unknown columns a KeyError.
    """
    left_keys, right_keys = as_list(left_columns), as_list(right_columns)
    if not method or not left_keys or len(left_keys) != len(right_keys):
        raise ValueError("a method and as many left as right columns are needed")
    require(left, left_keys)
    require(right, right_keys)
    keys = [F.col(r).alias(k) for r, k in zip(right_keys, left_keys)]
    fresh = [c for c in right.columns if c not in right_keys and c not in left.columns]
    joined = left.join(right.select(*keys, *fresh), left_keys, method)
    order = [*left.columns, *(fresh if method not in ("left_semi", "left_anti", "semi", "anti") else [])]
    joined = joined.select(*order)
    return joined.dropna() if drop_na else joined


def exclude_ids(left: DataFrame, excluded: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Rows of left whose key isn't in excluded; null keys stay. Without columns left is unchanged."""
    keys = as_list(columns)
    require(left, keys)
    require(excluded, keys)
    return left.join(excluded.select(*keys), keys, "left_anti") if keys else left


def point_in_time_join(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], left_time: str, values: Sequence[str], right_keys: Sequence[str] | None = None, right_time: str | None = None, prefix: str = "", tiebreak: Sequence[str] = (), collapse: bool = False, bucket: str | None = None
) -> DataFrame:
    """Each left row with the values of the newest right row of its keys that isn't later; null values without one.

    Both sides are put in one sequence by key and time and the last right row is carried on: one shuffle and one
    sort, linear in the rows, however many right rows a key has. At equal times the right row counts; among right
    rows of the same time the largest by tiebreak, then by values. Left rows with a null key match nothing. With
    collapse, left rows that share keys and time become one.

    A key with a large share of all rows would be one task's work. With bucket ('day', 'month', 'year') a key's
    sequence is cut there: each piece is carried on by itself, and begins with the last right row of the pieces before
    it, which come from one aggregated row for each key and bucket.
    """
    left_keys, right_keys = as_list(left_keys), as_list(right_keys) or as_list(left_keys)
    right_time = right_time or left_time
    require(left, [*left_keys, left_time])
    require(right, [*right_keys, right_time, *values, *tiebreak])
    if len(left_keys) != len(right_keys):
        raise ValueError("as many left as right keys are needed")
    names = [f"__k{n}" for n in range(len(left_keys))]
    payload = F.struct(*(F.col(v).alias(prefix + v) for v in values))
    if collapse:
        left = left.dropDuplicates([*left_keys, left_time])
    ours = left.select(*(F.col(k).alias(n) for k, n in zip(left_keys, names)), F.col(left_time).alias("__t"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"))
    theirs = right.where(F.col(right_time).isNotNull()).select(
        *(F.col(k).alias(n) for k, n in zip(right_keys, names)), F.col(right_time).alias("__t"), F.lit(0).alias("__side"), payload.alias("__value"), F.struct(*tiebreak, *values).alias("__tie")
    )
    both = ours.unionByName(theirs, allowMissingColumns=True)
    pieces = [*names, "__b"] if bucket else names
    if bucket:
        both = both.withColumn("__b", F.date_trunc(bucket, F.col("__t").cast("timestamp")))
    carried = F.last("__value", ignorenulls=True).over(Window.partitionBy(*pieces).orderBy("__t", "__side", "__tie").rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("__value", carried).where("__side = 1")
    if bucket:
        newest = both.groupBy(*pieces).agg(F.max(F.when(F.col("__side") == 0, F.struct("__t", "__tie", "__value")))["__value"].alias("__last"))
        before = Window.partitionBy(*names).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        begins = newest.select(*pieces, F.last("__last", ignorenulls=True).over(before).alias("__begin"))
        found = found.join(begins, pieces, "left").withColumn("__value", F.coalesce("__value", "__begin"))
    known = F.lit(True)
    for name in names:
        known = known & F.col(name).isNotNull()
    return found.select("__row.*", *(F.when(known & F.col("__t").isNotNull(), F.col("__value")[prefix + v]).alias(prefix + v) for v in values))


def point_in_time_join_by_range(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, values: Sequence[str], right_time: str, row_id: Sequence[str]) -> DataFrame:
    """The same by an equi-join with a condition on time and the largest right row of each left one.

    For a right side with few rows of a key; the join makes a row for every pair that the condition allows.
    """
    keys = as_list(keys)
    theirs = right.select(*(F.col(k).alias(f"__r_{k}") for k in keys), F.struct(F.col(right_time).alias("__t"), *values).alias("__value"))
    condition = F.col(left_time) >= F.col("__value.__t")
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"__r_{k}"))
    best = left.join(theirs, condition, "left").groupBy(*row_id).agg(F.max("__value").alias("__value"))
    return left.join(best, list(row_id)).select(*left.columns, *(F.col(f"__value.{v}").alias(v) for v in values))


def reconcile(source: DataFrame, target: DataFrame, on: str, count: str) -> DataFrame:
    """Counts of both sides by a full outer join: source_{count}, target_{count}, diff and relative diff."""
    joined = source.select(on, F.col(count).alias(f"source_{count}")).join(target.select(on, F.col(count).alias(f"target_{count}")), on, "full")
    s, t = F.col(f"source_{count}"), F.col(f"target_{count}")
    return joined.select(on, s, t, (F.coalesce(s, F.lit(0)) - F.coalesce(t, F.lit(0))).alias("diff"), relative_difference(s, t).alias("rel_diff"))


def union_frames(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both by column name, with NULL for columns that one side lacks."""
    return first.unionByName(second, allowMissingColumns=True)


def ratios(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """{a}_to_{b}_ratio: a / b rounded to 4 digits, null where b is zero."""
    return df.withColumns({f"{a}_to_{b}_ratio": ratio(a, b) for a, b in pairs})


def percentages(df: DataFrame, pairs: Sequence[tuple[str, str]], names: Mapping[tuple[str, str], str] | None = None) -> DataFrame:
    """{a}_pct: a / b * 100 rounded to 4 digits, null where b is zero; two pairs may not share a name."""
    wanted = [((names or {}).get((a, b), f"{a}_pct"), ratio(a, b, scale=100)) for a, b in pairs]
    if len({n for n, _ in wanted}) < len(wanted):
        raise ValueError("percentages would share a name; give names")
    return df.withColumns(dict(wanted))
