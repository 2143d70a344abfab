"""Checks that look at one row at a time.

Every check comes as a predicate, a Column that is true for a violation, and as
a function that returns the violating rows. The runner evaluates all predicates
on a table in a single aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numbers import as_column
from stratalake.functions.text import is_blank


def _bound(value) -> Column:
    """Bounds may be numbers, dates, Columns or SQL expressions as text."""
    return as_column(value) if isinstance(value, (str, Column)) else F.lit(value)


def outside_range(column: Column | str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    value = as_column(column)
    broken = []
    if min_value is not None:
        low = _bound(min_value)
        broken.append(~(value >= low) if inclusive else ~(value > low))
    if max_value is not None:
        high = _bound(max_value)
        broken.append(~(value <= high) if inclusive else ~(value < high))
    return reduce(or_, broken, F.lit(False))


def accepted_range(
    df: DataFrame, column: Column | str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    """Rows outside the bounds; NULL passes, and so does everything without bounds."""
    return df.filter(outside_range(column, min_value, max_value, inclusive))


def expression_false(expression: Column | str, column: str | None = None) -> Column:
    """With ``column`` the expression is the text that follows the column name."""
    return ~(as_column(expression) if column is None else F.expr(f"{column} {expression}"))


def expression_is_true(df: DataFrame, expression: Column | str, column: str | None = None) -> DataFrame:
    """Rows where the expression is false; a NULL result passes."""
    return df.filter(expression_false(expression, column))


def not_null(df: DataFrame, column: Column | str) -> DataFrame:
    return df.filter(as_column(column).isNull())


def blank(column: Column | str, trim_whitespace: bool = True) -> Column:
    value = as_column(column)
    return is_blank(value) if trim_whitespace else value == ""


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    """The empty values, one row each, after trimming if asked; NULL passes."""
    return df.filter(blank(F.col(column), trim_whitespace)).select(F.lit("").alias(column))


def differs(actual: Column | str, expected: Column | str) -> Column:
    return as_column(actual) != as_column(expected)


def assert_equal(df: DataFrame, actual: Column | str, expected: Column | str) -> DataFrame:
    """Rows whose two values differ; NULL on either side passes."""
    return df.filter(differs(actual, expected))


def not_accepted_values(df: DataFrame, column: str, values: Sequence, quote: bool = True) -> DataFrame:
    """The forbidden values that occur, once each, as ``value_field``.

    Without ``quote`` text values are SQL expressions.
    """
    forbidden = [as_column(v) if not quote and isinstance(v, str) else F.lit(v) for v in values]
    present = df.filter(F.col(column).isin(*forbidden))
    return present.select(F.col(column).alias("value_field")).distinct()


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
