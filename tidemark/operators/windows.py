"""Window functions: rolling statistics, lags, rates, the relative strength index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import rate_of_change, trailing, trailing_months
from tidemark.operators import require
from tidemark.operators.aggregation import AGGREGATES

_RANKING = frozenset("row_number rank dense_rank percent_rank cume_dist".split())
_WITH_ARGUMENTS = frozenset("ntile lag lead nth_value".split())


def window_operations(df: DataFrame, by_columns: Sequence[str], operations: Sequence[Mapping], orderby: Sequence | None = None) -> DataFrame:
    """Named functions over one window, all in one projection. Each operation: operation, column, alias, args.

    With an order and no frame, aggregates run up to the current row's peers, as in SQL.
    """
    require(df, by_columns)
    window = Window.partitionBy(*by_columns)
    window = window.orderBy(*orderby) if orderby else window
    outs = []
    for op in operations:
        name, column, args = op["operation"], op.get("column"), op.get("args", ())
        if name in _RANKING:
            value = getattr(F, name)()
        elif name in _WITH_ARGUMENTS:
            value = getattr(F, name)(*([column] if column else []), *args)
        elif name.lower() in AGGREGATES:
            value = getattr(F, name)(F.col(column) if column else F.lit(1))
        else:
            raise ValueError(f"window function {name!r} isn't allowed")
        outs.append(value.over(window).alias(op["alias"]))
    return df.select("*", *outs)


def lag_index(df: DataFrame, by_columns: Sequence[str], orderby: Sequence) -> DataFrame:
    """lags_num, 0 for the newest row of a group, and lags, lag_<n>."""
    require(df, by_columns)
    part = Window.partitionBy(*by_columns)
    number = (F.count(F.lit(1)).over(part) - F.row_number().over(part.orderBy(*orderby))).cast("int")
    return df.select("*", number.alias("lags_num"), F.concat(F.lit("lag_"), number.cast("string")).alias("lags"))


def _rolled(column: str, stat: str, frame) -> Column:
    if stat == "ravg":
        return F.round(F.avg(column).over(frame), 4)
    if stat == "rstd":
        return F.round(F.stddev_samp(column).over(frame), 4)
    return {"rmin": F.min, "rmax": F.max}[stat](column).over(frame)


def rolling(df: DataFrame, partition: Sequence[str], order: str, numeric: Sequence[str], categorical: Sequence[str] = (), windows: Sequence[int] = (3, 6), calendar: bool = False) -> DataFrame:
    """{c}_ravg_{w}m and _rstd_ for numeric columns, _rmin_ and _rmax_ for categorical ones, in one projection.

    A window is the last w rows, whatever months they are; with calendar it is the last w months.
    """
    require(df, [*partition, order, *numeric, *categorical])
    frames = {w: trailing_months(list(partition), order, w) if calendar else trailing(list(partition), [order], w) for w in windows}
    outs = [_rolled(c, stat, frame).alias(f"{c}_{stat}_{w}m") for c in numeric for w, frame in frames.items() for stat in ("ravg", "rstd")]
    outs += [_rolled(c, stat, frame).alias(f"{c}_{stat}_{w}m") for c in categorical for w, frame in frames.items() for stat in ("rmin", "rmax")]
    return df.select("*", *outs)


def changes(df: DataFrame, partition: Sequence[str], order: Sequence, columns: Sequence[str], lags: Sequence[int] = (1, 3, 6)) -> DataFrame:
    """{c}_lag_{n}m, {c}_diff_{n}m and {c}_roc_{n}m."""
    require(df, [*partition, *columns])
    window = Window.partitionBy(*partition).orderBy(*order)
    outs = []
    for c in columns:
        for n in lags:
            before = F.lag(c, n).over(window)
            outs += [before.alias(f"{c}_lag_{n}m"), (F.col(c) - before).alias(f"{c}_diff_{n}m"), rate_of_change(F.col(c), before).alias(f"{c}_roc_{n}m")]
    return df.select("*", *outs)


def generate_lags(
    df: DataFrame, pk: Sequence[str], tsk: Sequence, columns: Sequence[str], lags: Sequence[int], sliding_windows: Mapping[str, Sequence[Sequence[int]]] | None = None, relative_change: Sequence[Sequence[int]] | None = None
) -> DataFrame:
    """{c}_lag_{n}; {c}_{stat}_{s}_{e} over rows s to e, for mean and std; {c}_relchange_{a}_{r} between lags a and r.

    Lag 0 is the row itself. An order is needed; other statistics are a ValueError.
    """
    if not tsk:
        raise ValueError("lags need an order")
    require(df, [*pk, *columns])
    window = Window.partitionBy(*pk).orderBy(*tsk)
    at = lambda c, n: F.lag(c, n).over(window) if n else F.col(c)
    outs = [at(c, n).alias(f"{c}_lag_{n}") for c in columns for n in lags]
    stats = {"mean": F.avg, "std": F.stddev_samp}
    for stat, ranges in (sliding_windows or {}).items():
        if stat not in stats:
            raise ValueError(f"statistic {stat!r} is neither mean nor std")
        outs += [stats[stat](c).over(window.rowsBetween(s, e)).alias(f"{c}_{stat}_{s}_{e}") for c in columns for s, e in ranges]
    outs += [rate_of_change(at(c, a), at(c, r), digits=None).alias(f"{c}_relchange_{a}_{r}") for c in columns for a, r in relative_change or ()]
    return df.select("*", *outs)


def relative_strength(df: DataFrame, partition: Sequence[str], order: Sequence, column: str, rows: int = 14, digits: int = 4) -> DataFrame:
    """{column}_rsi_{rows}: 100 - 100 / (1 + average gain / average loss); null where there was no loss."""
    require(df, [*partition, column])
    window = Window.partitionBy(*partition).orderBy(*order)
    last = window.rowsBetween(1 - rows, 0)
    moved = df.withColumn("__delta", F.col(column) - F.lag(column, 1).over(window))
    gain, loss = F.greatest("__delta", F.lit(0.0)), F.greatest(-F.col("__delta"), F.lit(0.0))
    moved = moved.withColumns({"__gain": F.avg(gain).over(last), "__loss": F.avg(loss).over(last)})
    strength = F.col("__gain") / F.when(F.col("__loss") != 0, F.col("__loss"))
    return moved.withColumn(f"{column}_rsi_{rows}", F.round(100 - 100 / (1 + strength), digits)).drop("__delta", "__gain", "__loss")
