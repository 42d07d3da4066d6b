"""Selecting, renaming, casting and deriving columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType

from tidemark.functions.exprs import checked_int, half_month, is_null_token
from tidemark.operators import as_list, require

#: Functions that parameters may name. Python-side, aggregate and generator functions aren't among them.
SCALAR_FUNCTIONS = frozenset(
    "abs acos add_months ascii asin atan atan2 base64 bin bround cbrt ceil coalesce concat concat_ws conv cos crc32 current_date date_add date_format date_sub "
    "date_trunc datediff dayofmonth dayofweek dayofyear exp expm1 factorial floor format_number greatest hash hex hour hypot initcap instr isnan isnull last_day least "
    "length levenshtein lit locate log log10 log1p log2 lower lpad ltrim md5 minute month months_between nanvl next_day nullif pmod pow quarter regexp_extract "
    "regexp_replace repeat reverse rint round rpad rtrim second sha1 sha2 signum sin soundex split sqrt substring tan to_date to_timestamp translate trim trunc "
    "try_add try_divide try_multiply try_subtract unhex upper weekofyear xxhash64 year".split()
)
COLUMN_METHODS = frozenset("cast contains startswith endswith like rlike isNull isNotNull substr between isin eqNullSafe".split())
BINARY_OPERATORS = {
    "add": lambda a, b: a + b,
    "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b,
    "truediv": lambda a, b: F.try_divide(a, b),
    "mod": lambda a, b: F.when(b != 0, a % b),
    "pow": lambda a, b: F.pow(a, b),
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
    "and_": lambda a, b: a & b,
    "or_": lambda a, b: a | b,
}


def select_columns(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """The columns in the given order; all of them for an empty list. KeyError for unknown ones."""
    names = as_list(columns)
    require(df, names)
    return df.select(*names) if names else df


def select_distinct(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    names = as_list(columns)
    require(df, names)
    return df.select(*names).distinct() if names else df


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """New names for columns; KeyError for unknown ones, ValueError where two columns would share a name."""
    require(df, names)
    after = [names.get(c, c) for c in df.columns]
    if len(set(after)) < len(after):
        raise ValueError(f"columns would share names: {sorted({c for c in after if after.count(c) > 1})}")
    return df.withColumnsRenamed(dict(names))


def concat_columns(df: DataFrame, new_column_name: str, columns: Sequence[str], lit_str: str | None = None) -> DataFrame:
    """Columns joined as text, null if any is; a single one gets lit_str before it. Without columns df is unchanged."""
    names = as_list(columns)
    require(df, names)
    if not names:
        return df
    if len(names) == 1:
        if not lit_str:
            raise ValueError("a single column needs lit_str")
        return df.withColumn(new_column_name, F.concat(F.lit(lit_str), F.col(names[0])))
    return df.withColumn(new_column_name, F.concat(*names))


def constant_column(df: DataFrame, new_column_name: str, value: Any, data_type: str) -> DataFrame:
    return df.withColumn(new_column_name, F.lit(value).cast(data_type))


def decimals_to(df: DataFrame, target: str = "float") -> DataFrame:
    """Every decimal column as the target type."""
    return df.withColumns({f.name: F.col(f.name).cast(target) for f in df.schema if isinstance(f.dataType, DecimalType)})


def longs_to_integers(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every bigint column as int, null where a value doesn't fit; `keep` names columns that stay."""
    return df.withColumns({f.name: checked_int(F.col(f.name)) for f in df.schema if isinstance(f.dataType, LongType) and f.name not in keep})


def standardize_output(df: DataFrame, columns: Sequence[str], keys: Mapping[str, str], prefix: str) -> DataFrame:
    """A feature table's shape in one projection: keys renamed, other columns prefixed, decimals as float, longs as int."""
    require(df, columns)
    types = {f.name: f.dataType for f in df.schema}
    out = []
    for name in columns:
        column = F.col(name)
        if isinstance(types[name], DecimalType):
            column = column.cast("float")
        elif isinstance(types[name], LongType):
            column = checked_int(column)
        out.append(column.alias(keys.get(name, prefix + name)))
    return df.select(*out)


def _function(name: str):
    if name not in SCALAR_FUNCTIONS:
        raise ValueError(f"function {name!r} isn't allowed")
    return getattr(F, name)


def _apply(function, values: Sequence | Mapping) -> Column:
    as_arg = lambda v: F.col(v) if isinstance(v, str) else v
    return function(**values) if isinstance(values, Mapping) else function(*map(as_arg, values))


def math_operations(df: DataFrame, operations: Sequence[Mapping]) -> DataFrame:
    """Columns from binary operators on two values, or from named functions.

    Each operation: new_column_name, operator, values, source_operator ('operator' or 'spark_function'). Strings name
    columns, other values are literals. Division by zero is null. Another source is a ValueError.
    """
    for op in operations:
        if op["source_operator"] == "operator":
            if op["operator"] not in BINARY_OPERATORS:
                raise ValueError(f"operator {op['operator']!r} isn't allowed")
            left, right = (F.col(v) if isinstance(v, str) else F.lit(v) for v in op["values"][:2])
            column = BINARY_OPERATORS[op["operator"]](left, right)
        elif op["source_operator"] == "spark_function":
            column = _apply(_function(op["operator"]), op["values"])
        else:
            raise ValueError(f"unknown source_operator {op['source_operator']!r}")
        df = df.withColumn(op["new_column_name"], column)
    return df


def function_operations(df: DataFrame, operations: Sequence[Mapping]) -> DataFrame:
    """Columns from named functions ('functions') or from methods of a column ('column': the first value is the column)."""
    for op in operations:
        values = op["values"]
        if op["source_function"] == "functions":
            column = _apply(_function(op["function"]), values)
        elif op["source_function"] == "column":
            if op["function"] not in COLUMN_METHODS:
                raise ValueError(f"method {op['function']!r} isn't allowed")
            column = getattr(F.col(values[0]), op["function"])(*values[1:])
        else:
            raise ValueError(f"unknown source_function {op['source_function']!r}")
        df = df.withColumn(op["new_column_name"], column)
    return df


def _literal_or_sql(text: Any) -> Column:
    if text is None or is_null_token(str(text)):
        return F.lit(None)
    return F.expr(str(text))


def choose_columns_as_value(df: DataFrame, new_column_name: str, cases: Sequence[Mapping[str, str]], else_value: Any = None, cast_type: str | None = None) -> DataFrame:
    """A CASE whose conditions and values are SQL; null tokens, and a missing else_value, are NULL.

    Branches of different types are cast to text unless cast_type is given, then to that.
    """
    kind = cast_type or "string"
    column = None
    for case in cases:
        value = _literal_or_sql(case["column"]).cast(kind)
        column = F.when(F.expr(case["condition"]), value) if column is None else column.when(F.expr(case["condition"]), value)
    last = _literal_or_sql(else_value).cast(kind)
    return df.withColumn(new_column_name, last if column is None else column.otherwise(last))


def categorize_by_fixed_values(df: DataFrame, column: str, new_column_name: str, values: Mapping[str, str], else_value: Any = None, cast_type: str | None = None) -> DataFrame:
    """A category for a column: {category: condition on the column, such as `> 3` or `in (1, 2)`}.

    else_value is a column if it names one, else a literal; missing or a null token, it is NULL.
    """
    require(df, [column])
    out = None
    for category, condition in values.items():
        test = F.expr(f"`{column}` {condition}")
        out = F.when(test, F.lit(category)) if out is None else out.when(test, F.lit(category))
    if else_value is None or is_null_token(str(else_value)):
        last = F.lit(None).cast("string")
    elif else_value in df.columns:
        last = F.col(else_value).cast("string")
    else:
        last = F.lit(str(else_value))
    out = last if out is None else out.otherwise(last)
    return df.withColumn(new_column_name, out.cast(cast_type) if cast_type else out)


def roll_up(df: DataFrame, column: str, new_column_name: str, groups: Mapping[str, Sequence], same: Sequence = (), otherwise: Any = None, keep_null: bool = False) -> DataFrame:
    """A coarser category: {category: values of the column}. Values in same stay as they are, all others become otherwise.

    A null is one of the others, unless keep_null is set.
    """
    require(df, [column])
    source = F.col(column)
    out = F.when(source.isin(*same), source) if same else F.when(F.lit(False), source)
    for category, values in groups.items():
        out = out.when(source.isin(*values), F.lit(category))
    return df.withColumn(new_column_name, (out.when(source.isNotNull(), F.lit(otherwise)) if keep_null else out.otherwise(F.lit(otherwise))))


def binarize(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Columns from SQL expressions, one after the other, so later ones see earlier ones."""
    for name, sql in columns.items():
        df = df.withColumn(name, F.expr(sql))
    return df


def cast_schema(df: DataFrame, fields: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One projection to configured names and types: {source: {name, data_type, format_source?}}.

    A value that can't be cast is null. DATE needs format_source; `yyyy-mm-qq` stands for half-month codes. Missing
    names, types or formats are a ValueError, unknown source columns a KeyError.
    """
    require(df, fields)
    out = []
    for source, field in fields.items():
        if not field.get("name") or not field.get("data_type"):
            raise ValueError(f"field {source!r} needs name and data_type")
        kind = field["data_type"].lower()
        if kind == "date":
            if not field.get("format_source"):
                raise ValueError(f"date field {source!r} needs format_source")
            column = half_month(source) if field["format_source"] == "yyyy-mm-qq" else F.try_to_date(F.col(source).cast("string"), field["format_source"])
        else:
            column = F.col(source).try_cast(kind)
        out.append(column.alias(field["name"]))
    return df.select(*out)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]
