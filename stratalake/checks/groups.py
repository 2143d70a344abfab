"""Checks on a table or on each of its groups.

All are one aggregation, pre-aggregated in the input tasks, so a hot group
reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from stratalake.functions.dates import add_part
from stratalake.functions.numbers import as_column

FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """The table, or the groups, without a single non-NULL value."""
    return (
        df.groupBy(*group_by).agg(F.count(F.col(column)).alias("filler_column")).filter("filler_column = 0")
    )


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """The table, or the groups, with exactly one distinct non-NULL value.

    One distinct value means that the least equals the greatest, which needs no
    second shuffle for the distinct values. Text and nested values are counted:
    their least value would take a sort in place of a hash aggregation.
    """
    value = F.col(column)
    if not isinstance(df.schema[column].dataType, FIXED_WIDTH):
        counts = df.groupBy(*group_by).agg(F.count_distinct(value).alias("filler_column"))
        return counts.filter("filler_column = 1")
    return (
        df.groupBy(*group_by)
        .agg(F.min(value).alias("_least"), F.max(value).alias("_greatest"))
        .filter(F.col("_least") == F.col("_greatest"))
        .select(*group_by, F.lit(1).cast("bigint").alias("filler_column"))
    )


def not_null_proportion(
    df: DataFrame,
    column: str,
    at_least: float | Decimal,
    at_most: float | Decimal = 1,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """The table, or the groups, whose share of non-NULL values is outside the closed range."""
    low, high = (F.lit(Decimal(str(share))) for share in (at_least, at_most))
    held, total = F.count(F.col(column)), F.count(F.lit(1))
    share = held.cast("decimal(20,0)") / F.nullif(total, F.lit(0)).cast("decimal(20,0)")
    shares = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    outside = (F.col("not_null_proportion") < low) | (F.col("not_null_proportion") > high)
    return shares.filter(outside)


def recency(
    df: DataFrame,
    field: Column | str,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """The table, or the groups, whose latest value is older than ``as_of`` minus the interval.

    ``as_of`` is the current time unless given. No value at all passes.
    """
    now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    oldest = add_part(datepart, -interval, now)
    latest = F.max(as_column(field))
    if ignore_time_component:
        latest, oldest = latest.cast("date"), oldest.cast("date")
    return (
        df.groupBy(*group_by)
        .agg(latest.alias("most_recent"))
        .withColumn("threshold", oldest)
        .filter(F.col("most_recent") < F.col("threshold"))
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their counts."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def unique_combination_of_columns(
    df: DataFrame, columns: Sequence[str], quote_columns: bool = False
) -> DataFrame:
    """Combinations that occur more than once; NULLs are equal. Quoted names are taken literally."""
    keys = [F.col(f"`{c}`" if quote_columns else c) for c in columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
