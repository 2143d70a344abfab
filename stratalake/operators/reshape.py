"""Rows to columns and columns to rows."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from stratalake.functions.numbers import as_column
from stratalake.functions.text import slugify_name

COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "like": F.like,
    "ilike": F.ilike,
    "not like": lambda left, right: ~F.like(left, right),
}


def _branch_value(value: Column | str | int | float | None) -> Column:
    return as_column(value) if isinstance(value, (Column, str)) else F.lit(value)


def pivot_columns(
    column: str,
    values: Sequence,
    alias: bool = True,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Column | str | int | float = 1,
    else_value: Column | str | int | float | None = 0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value; text in ``then_value`` or ``else_value`` is a SQL expression.

    Column names are the values with prefix and suffix, as they are or, without
    ``quote_identifiers``, as slugs.
    """
    if cmp.lower() not in COMPARISONS:
        raise ValueError(f"cmp must be one of {sorted(COMPARISONS)}, got {cmp!r}")
    compare = COMPARISONS[cmp.lower()]

    def aggregate(value) -> Column:
        picked = F.when(compare(F.col(column), F.lit(value)), _branch_value(then_value)).otherwise(
            _branch_value(else_value)
        )
        if not distinct:
            return F.call_function(agg, picked)
        if agg.lower() == "count":
            return F.count_distinct(picked)
        if agg.lower() == "sum":
            return F.sum_distinct(picked)
        # Repeated values do not change the other aggregates that make sense here.
        if agg.lower() in ("min", "max"):
            return F.call_function(agg, picked)
        raise ValueError(f"distinct is supported for count, sum, min and max, not {agg!r}")

    def named(value) -> str:
        name = f"{prefix}{value}{suffix}"
        return name if quote_identifiers else slugify_name(name)

    return [aggregate(v).alias(named(v)) if alias else aggregate(v) for v in values]


def pivot(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, **options) -> DataFrame:
    """Grouped form of :func:`pivot_columns`: one shuffle, pre-aggregated in the input tasks.

    Several distinct aggregates would copy every row once per value. Where a row
    counts for one value only, the rows are made distinct first instead.
    """
    one_value_per_row = options.get("cmp", "=") == "=" and options.get("else_value", 0) is None
    if options.get("distinct") and one_value_per_row and column not in keys:
        then_value = _branch_value(options.get("then_value", 1)).alias("_then")
        df = df.select(*keys, column, then_value).distinct()
        options = {**options, "distinct": False, "then_value": F.col("_then")}
    return df.groupBy(*keys).agg(*pivot_columns(column, values, **options))


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per value column, in one scan; ``exclude`` columns stay, ``remove`` columns go."""
    if df is None:
        raise ValueError("unpivot needs a DataFrame")
    skipped = {name.lower() for name in (*exclude, *remove)}
    fields = [f for f in df.schema.fields if f.name.lower() not in skipped]
    if not fields:
        raise ValueError("no columns left to unpivot")

    def as_value(field) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, BooleanType):
            value = value.cast("string")
        return value.cast(cast_to).alias(field.name)

    ids = [F.col(f"`{name}`").alias(name) for name in exclude]
    typed = df.select(*ids, *[as_value(f) for f in fields])
    return typed.unpivot(
        [f"`{name}`" for name in exclude], [f"`{f.name}`" for f in fields], field_name, value_name
    )
