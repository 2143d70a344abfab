"""Small results used to shape other queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.numbers import as_column
from stratalake.operators.ordered import numbered


def column_values(
    df: DataFrame,
    column: Column | str,
    order_by: Column | str = "count(*)",
    descending: bool | None = None,
    max_records: int | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Distinct values of a column as ``value``; NULL is a value too.

    ``order_by`` is an aggregate or the column itself. Counts sort high to low by
    default, anything else low to high. The value breaks ties.
    """
    rows = df if where is None else df.filter(where)
    by_count = isinstance(order_by, str) and order_by.replace(" ", "").lower() == "count(*)"
    high_first = by_count if descending is None else descending
    grouped = rows.groupBy(as_column(column).alias("value")).agg(as_column(order_by).alias("_rank"))
    rank = F.col("_rank").desc() if high_first else F.col("_rank").asc()
    ordered = grouped.orderBy(rank, F.col("value").asc()).select("value")
    return ordered if max_records is None else ordered.limit(max_records)


# What a driver holds easily; callers that have room for more say so.
DRIVER_ROWS = 1_000_000


def small_rows(df: DataFrame, max_rows: int = DRIVER_ROWS) -> list:
    """Rows on the driver; a result with more rows than the limit raises instead of being cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows")
    return rows


def column_value_list(
    df: DataFrame | None, column: Column | str, default: list | None = None, max_rows: int = DRIVER_ROWS, **options
) -> list:
    """The values as a Python list; ``default`` stands in for a missing or empty table.

    More than ``max_rows`` values raise; ``column_values`` has them as a DataFrame.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    values = [row["value"] for row in small_rows(column_values(df, column, **options), max_rows)]
    return values if values or default is None else default


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or None when there is no such table."""
    try:
        return spark.table(name)
    except AnalysisException as error:
        if error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
            return None
        raise


def single_value(df: DataFrame, default=None):
    """First column of the first row; ``default`` only when there are no rows."""
    row = df.limit(1).select(F.col(f"`{df.columns[0]}`")).first()
    return default if row is None else row[0]


def single_value_column(df: DataFrame, default: Column | None = None) -> Column:
    """The same value as a scalar subquery, for use inside another DataFrame's query."""
    first = F.first(F.col(f"`{df.columns[0]}`"))
    empty = F.count(F.lit(1)) == 0
    fallback = F.lit(None) if default is None else default
    return df.limit(1).agg(F.when(empty, fallback).otherwise(first)).scalar()


def results_as_dict(df: DataFrame, max_rows: int = DRIVER_ROWS) -> dict[str, list]:
    """Column name to list of values, in row order and with NULLs."""
    rows = small_rows(df, max_rows)
    return {name: [row[i] for row in rows] for i, name in enumerate(df.columns)}


def results_in_columns(df: DataFrame, order_by: Sequence[str], n_ranges: int | None = None) -> DataFrame:
    """The values of each column with their positions: ``column_name``, ``position`` from 0, and ``value`` as text.

    The dictionary of a result of any size: no list of it is in one row.
    """
    placed = numbered(df, order_by, "_position", n_ranges)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]
    every = placed.select(F.col("_position").alias("position"), F.explode(F.array(*entries)).alias("_e"))
    return every.select("_e.column_name", "position", "_e.value")


def page(df: DataFrame, order_by: Sequence[str], first: int, n_rows: int) -> list:
    """Rows ``first`` to ``first + n_rows - 1`` in the order of some columns, on the driver."""
    placed = numbered(df, order_by, "_position")
    rows = placed.filter(F.col("_position").between(first, first + n_rows - 1)).orderBy("_position")
    return small_rows(rows.drop("_position"), n_rows)


def results_as_arrays(df: DataFrame, order_by: str, max_rows: int = DRIVER_ROWS) -> DataFrame:
    """One row with an array per column, ordered by a unique column, NULLs kept.

    The whole result goes into one row: it is for small results, and a larger one than the limit
    raises. ``results_in_columns`` has it in rows.
    """
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"result has more than {max_rows} rows")
    record = F.struct(F.col(order_by).alias("_key"), F.struct(*df.columns).alias("_row"))
    packed = df.agg(F.transform(F.array_sort(F.collect_list(record)), lambda r: r["_row"]).alias("rows"))
    return packed.select(*[F.col("rows").getField(name).alias(name) for name in df.columns])
