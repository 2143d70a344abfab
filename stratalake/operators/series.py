"""Number series and date spines."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.dates import CALENDAR_PARTS, add_part, boundaries_between


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1 to ``upper_bound`` as ``generated_number``; the executors make the rows."""
    if upper_bound <= 0:
        raise ValueError(f"upper bound must be positive, got {upper_bound}")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


def _moment(value: date | datetime | str | Column) -> Column:
    """A point in time; text is a SQL expression."""
    if isinstance(value, Column):
        return value
    return F.expr(value) if isinstance(value, str) else F.lit(value)


def date_spine(
    spark: SparkSession,
    datepart: str,
    start: date | datetime | str | Column,
    end: date | datetime | str | Column,
) -> DataFrame:
    """One row per date part from ``start`` (included) to ``end`` (excluded), as ``date_<part>``.

    Bounds are constants: dates, times or SQL text such as ``date'2024-01-01'``.
    Calendar parts counted from midnight give dates, anything else gives times.
    """
    start_at, end_at = (_moment(m).cast("timestamp_ntz") for m in (start, end))
    at_midnight = start_at == F.date_trunc("day", start_at)
    bounds = spark.range(1).select(boundaries_between(datepart, start_at, end_at), at_midnight)
    periods, whole_days = bounds.first()
    name = f"date_{datepart.lower()}"
    moment = add_part(datepart, F.col("generated_number") - 1, start_at)
    spine = generate_series(spark, periods).select(moment.alias(name)).filter(F.col(name) <= end_at)
    if whole_days and datepart.lower() in CALENDAR_PARTS:
        return spine.select(F.col(name).cast("date").alias(name))
    return spine
