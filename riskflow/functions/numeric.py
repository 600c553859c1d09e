"""Numeric coercion and NaN handling, as SQL expression text.

Rules and features are generated from the contract by the dozen. They are built as
SQL text, which reaches Spark in one call each, and stay inside code generation.

NaN is a missing value here. Spark orders NaN above every number, so a NaN that
reaches a range rule would be reported as too large; it becomes NULL first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# Accepted number text. Spark's cast alone would also take a trailing d or f.
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"
FLOATS = (T.DoubleType, T.FloatType)


def quoted(column: str) -> str:
    """A column name for SQL text."""
    return "`" + column.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    """A string for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double_literal(value: float) -> str:
    """A double for SQL text that reads back as the same number."""
    value = float(value)
    if value != value or value in (float("inf"), float("-inf")):
        return f"double('{value}')"
    return f"{value!r}D"


def number(column: str, data_type: T.DataType) -> str:
    """The value as a double, or NULL where it is not a number."""
    c = quoted(column)
    if isinstance(data_type, FLOATS):
        return f"nanvl(cast({c} as double), cast(null as double))"
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return f"cast({c} as double)"
    if isinstance(data_type, T.StringType):
        return f"case when {c} rlike r'{NUMBER_TEXT}' then try_cast(trim({c}) as double) end"
    return "cast(null as double)"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating-point column."""
    if not any(isinstance(f.dataType, FLOATS) for f in df.schema):
        return df
    return df.selectExpr(*[
        f"{number(f.name, f.dataType)} as {quoted(f.name)}" if isinstance(f.dataType, FLOATS) else quoted(f.name)
        for f in df.schema
    ])
