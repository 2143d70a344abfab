"""Date arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date parts that are understood.
DATE_PARTS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]
CALENDAR_PARTS = ["day", "week", "month", "quarter", "year"]


def _part(datepart: str) -> str:
    part = datepart.lower()
    if part not in DATE_PARTS:
        raise ValueError(f"date part must be one of {DATE_PARTS}, got {datepart!r}")
    return part


def add_part(datepart: str, amount: Column | int, start: Column) -> Column:
    """``start`` moved by ``amount`` date parts; a DATE moved by calendar parts stays a timestamp."""
    quantity = amount if isinstance(amount, Column) else F.lit(amount)
    return F.timestamp_add(_part(datepart), quantity, start)


def boundaries_between(datepart: str, start: Column, end: Column) -> Column:
    """How many starts of a date part lie after ``start`` and up to ``end``; weeks start on Sunday."""
    part = _part(datepart)
    shift = F.expr("INTERVAL 1 DAY") if part == "week" else F.expr("INTERVAL 0 DAY")

    def floor_to_part(moment: Column) -> Column:
        return F.date_trunc(part, moment.cast("timestamp_ntz") + shift)

    return F.timestamp_diff(part, floor_to_part(start), floor_to_part(end))


def _week_count(day: Column, anchor: str) -> Column:
    return F.floor(F.datediff(day, F.lit(anchor).cast("date")) / 7)


def business_days(start: Column, end: Column) -> Column:
    """Weekdays from ``start`` to ``end``, both included; NULL when ``end`` is earlier or one is NULL.

    Closed form: all days minus the Saturdays and Sundays, each counted as the
    difference of whole weeks since a known Saturday and a known Sunday.
    """
    before = F.date_sub(start, 1)
    saturday, sunday = "1970-01-03", "1970-01-04"
    saturdays = _week_count(end, saturday) - _week_count(before, saturday)
    sundays = _week_count(end, sunday) - _week_count(before, sunday)
    days = F.datediff(end, start).cast("bigint") + 1 - saturdays - sundays
    return F.when(end >= start, days)
