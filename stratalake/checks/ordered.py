"""Checks that compare neighbouring rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from stratalake.functions.dates import add_part
from stratalake.functions.numbers import as_column
from stratalake.functions.text import slugify_name
from stratalake.operators.counted import expand_counts
from stratalake.operators.ordered import ROWS_PER_RANGE, hot_groups, split_groups, with_neighbour

Rows = Callable[[DataFrame], DataFrame]


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
    n_ranges: int | None = None,
) -> DataFrame:
    """Rows whose value is not the previous one plus ``interval`` (date parts if given).

    The first value passes, and so does NULL.
    """
    previous = f"previous_{slugify_name(column)}"
    present = df.filter(F.col(column).isNotNull()).select(*group_by, column)
    plain = lambda rows: with_neighbour(rows, column, previous, "previous", group_by).drop("_end")
    counted = lambda rows: _previous_of_counted_values(rows, column, previous, group_by, n_ranges)
    linked = _by_group_size(present, group_by, rows_per_range, plain, counted)

    before = F.col(previous)
    if datepart:
        moment = "timestamp" if isinstance(df.schema[column].dataType, TimestampType) else "timestamp_ntz"
        follows = F.col(column).cast(moment) == add_part(datepart, interval, before.cast(moment))
    else:
        follows = F.col(column) == before + interval
    broken = linked.filter(~follows)
    return expand_counts(broken, "_n_rows") if "_n_rows" in linked.columns else broken


def _by_group_size(df: DataFrame, group_by: Sequence[str], rows_per_range: int, plain: Rows, counted: Rows) -> DataFrame:
    """Small groups in one window each; hot groups, or a table without groups, in ranges and with counts."""
    if not group_by:
        return counted(df)
    hot = hot_groups(df, group_by, rows_per_range)
    if hot is None:
        return plain(df)
    cut, whole = split_groups(df, hot)
    return plain(whole).withColumn("_n_rows", F.lit(1).cast("bigint")).unionByName(counted(cut))


def _previous_of_counted_values(
    present: DataFrame, column: str, previous: str, group_by: Sequence[str], n_ranges: int | None
) -> DataFrame:
    """Values with their predecessors as counted rows.

    Equal values are counted before anything is sorted. The first copy follows
    the next lower value, every other copy follows the value itself.
    """
    values = present.groupBy(*group_by, column).agg(F.count(F.lit(1)).alias("_copies"))
    linked = with_neighbour(values, column, "_before", "previous", group_by, in_ranges=True, n_ranges=n_ranges)
    steps = F.array(
        F.struct(F.col("_before").alias("before"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.col(column).alias("before"), (F.col("_copies") - 1).alias("n")),
    )
    return (
        linked.withColumn("_step", F.explode(steps))
        .select(*group_by, column, F.col("_step.before").alias(previous), F.col("_step.n").alias("_n_rows"))
        .filter("_n_rows > 0")
    )


# How an upper bound must relate to the next lower bound.
GAP_RULES = {
    "not_allowed": ("=", "equal_to"),
    "allowed": ("<=", "less_than_or_equal_to"),
    "required": ("<", "less_than"),
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound: Column | str,
    upper_bound: Column | str,
    partition_by: Column | str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
    n_ranges: int | None = None,
) -> DataFrame:
    """Ranges that are empty or reversed, or that overlap the next one under the gap rule.

    A NULL bound is a violation. The last range has no next one to respect.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {list(GAP_RULES)}, got {gaps!r}")
    if not isinstance(zero_length_range_allowed, bool):
        raise ValueError(f"zero_length_range_allowed must be True or False, got {zero_length_range_allowed!r}")
    sign, sign_words = GAP_RULES[gaps]
    length_sign, length_words = ("<=", "less_than_or_equal_to") if zero_length_range_allowed else ("<", "less_than")
    groups = [] if partition_by is None else ["partition_by_col"]
    partition = [] if partition_by is None else [as_column(partition_by).alias("partition_by_col")]
    bounds = df.select(
        *partition, as_column(lower_bound).alias("lower_bound"), as_column(upper_bound).alias("upper_bound")
    )
    names = {"column": "lower_bound", "into": "next_lower_bound", "side": "next", "end_flag": "is_last_record"}
    plain = lambda rows: with_neighbour(rows, group_by=groups, then_by=["upper_bound"], **names)
    linked = _by_group_size(
        bounds, groups, rows_per_range, plain, lambda rows: _next_of_counted_bounds(rows, groups, n_ranges)
    )

    own_length = F.coalesce(F.expr(f"lower_bound {length_sign} upper_bound"), F.lit(False))
    to_next = F.coalesce(
        F.expr(f"upper_bound {sign} next_lower_bound"), F.col("is_last_record"), F.lit(False)
    )
    length_name = f"lower_bound_{length_words}_upper_bound"
    next_name = f"upper_bound_{sign_words}_next_lower_bound"
    judged = linked.withColumn(length_name, own_length).withColumn(next_name, to_next)
    broken = judged.filter(~(F.col(length_name) & F.col(next_name)))
    return expand_counts(broken, "_n_rows") if "_n_rows" in linked.columns else broken


def _next_of_counted_bounds(bounds: DataFrame, groups: Sequence[str], n_ranges: int | None) -> DataFrame:
    """The same as counted rows, without sorting the rows that share a lower bound.

    Of the rows with one lower bound, only the one that sorts last - a copy of
    the greatest upper bound - is followed by another lower bound. All others are
    followed by their own.
    """
    keys = [*groups, "lower_bound"]
    lasts = bounds.groupBy(*keys).agg(F.max("upper_bound").alias("upper_bound"))
    one = F.lit(1).cast("bigint")
    final = with_neighbour(
        lasts, "lower_bound", "next_lower_bound", "next", groups, [], True, n_ranges, "is_last_record"
    ).withColumn("_n_rows", one)
    others = (
        bounds.select(*keys, "upper_bound", one.alias("n"))
        .unionByName(lasts.select(*keys, "upper_bound", (-one).alias("n")))
        .groupBy(*keys, "upper_bound")
        .agg(F.sum("n").alias("_n_rows"))
        .filter("_n_rows > 0")
        .withColumns({"next_lower_bound": F.col("lower_bound"), "is_last_record": F.lit(False)})
    )
    return final.unionByName(others)
