"""Neighbours in sort order without a single-task window.

A window over a whole table, or over one hot group, sorts all of its rows in one
task. Here Spark's range shuffle deals the values themselves, of any type, into as
many ranges as there are shuffle partitions. Neighbours inside a range come from a
window per (group, range); the ends of the ranges are joined up by a second window
that sees one row per (group, range).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import scratch_path

ROWS_PER_RANGE = 200_000
SAMPLED_ROWS_PER_RANGE = 100


def _with_mark(df: DataFrame, groups: DataFrame, mark: str) -> DataFrame:
    """Whether a row's group is listed; how the list is joined is left to Spark, by its size."""
    keys = {name: f"_listed_{name}" for name in groups.columns}
    listed = groups.withColumnsRenamed(keys).withColumn(mark, F.lit(True))
    same = [F.col(name).eqNullSafe(F.col(key)) for name, key in keys.items()]
    joined = df.join(listed, same, "left").drop(*keys.values())
    return joined.withColumn(mark, F.col(mark).isNotNull())


def by_rows(rows_per_range: int) -> Callable[[int], int]:
    """As many ranges as it takes to hold ``rows_per_range`` rows in each."""
    return lambda rows: math.ceil(rows / rows_per_range)


def hot_groups(df: DataFrame, group_by: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame | None:
    """A written table of the groups with clearly more than ``rows_per_range`` rows, or None.

    Sizes come from a sample; a group that is missed or listed for nothing costs
    balance only. Only the group columns are read.
    """
    rows = df.count()
    share = min(1.0, SAMPLED_ROWS_PER_RANGE / rows_per_range)
    sizes = df.select(*group_by).sample(share, seed=17).groupBy(*group_by).agg(F.count(F.lit(1)).alias("_n"))
    if rows <= 2 * rows_per_range:
        return None
    large = _written(sizes.filter(F.col("_n") > 2 * share * rows_per_range).drop("_n"), "hot-groups")
    return None if large.isEmpty() else large


def split_groups(df: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of listed groups, and all others."""
    marked = _with_mark(df, groups, "_hot")
    return marked.filter("_hot").drop("_hot"), marked.filter("NOT _hot").drop("_hot")


def _written(df: DataFrame, purpose: str) -> DataFrame:
    """Whatever runs again later sees the same rows."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_neighbour(
    df: DataFrame,
    column: str,
    into: str,
    side: str,
    group_by: Sequence[str] = (),
    then_by: Sequence[str] = (),
    in_ranges: bool = False,
    n_ranges: int | None = None,
    end_flag: str = "_end",
) -> DataFrame:
    """``df`` with the value of the row before (``previous``) or after (``next``) in its group.

    Rows are ordered by ``column``, then ``then_by``, NULLs first, and then all other
    columns, so that ties have one order everywhere. ``end_flag`` is true for the
    first or last row of the group, which has no such neighbour.

    With ``in_ranges`` no group is sorted by one task: rows are dealt by group and
    value into ``n_ranges`` ranges, else as many as shuffle partitions. Copies of one row
    share a range: count them before.
    """
    groups = [F.col(g) for g in group_by] or [F.lit(0)]
    value = F.col(column)
    others = [c for c in df.columns if c not in (column, *group_by, *then_by)]
    order = [value, *[F.col(c) for c in (*then_by, *others)]]
    step = F.lag if side == "previous" else F.lead
    if not in_ranges:
        window = Window.partitionBy(*groups).orderBy(*order)
        return df.withColumns({into: step(value).over(window), end_flag: step(F.lit(1)).over(window).isNull()})

    keys = [*[F.col(g) for g in group_by], *order]
    dealt = df.repartitionByRange(n_ranges, *keys) if n_ranges else df.repartitionByRange(*keys)
    ranged = _written(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    in_order = Window.partitionBy(*[F.col(g) for g in group_by], F.col("_range")).orderBy(*order)
    local = ranged.withColumns({into: step(value).over(in_order), end_flag: step(F.lit(1)).over(in_order).isNull()})
    inside = local.filter(~F.col(end_flag)).drop("_range")

    # The row at the end of a range, and the value at the other end for the range beside it.
    row = F.struct(column, *then_by, *others)
    near, far = (F.min(row), F.max(value)) if side == "previous" else (F.max(row), F.min(value))
    across = Window.partitionBy(*groups).orderBy("_range")
    ends = (
        ranged.groupBy(*group_by, "_range")
        .agg(near.alias("_row"), far.alias("_far"))
        .withColumns({into: step("_far").over(across), end_flag: step(F.lit(1)).over(across).isNull()})
        .select(*group_by, "_row.*", into, end_flag)
    )
    return inside.unionByName(ends)


def numbered(df: DataFrame, order_by: Sequence[str], into: str, n_ranges: int | None = None) -> DataFrame:
    """``df`` with the number of each row in the order of some columns, from 0; ties are ordered by all others.

    Rows are dealt by value into ranges and numbered there; the counts of the ranges say where each begins. So no
    task has more than a range.
    """
    others = [c for c in df.columns if c not in order_by]
    keys = [F.col(f"`{c}`") for c in (*order_by, *others)]
    dealt = df.repartitionByRange(n_ranges, *keys) if n_ranges else df.repartitionByRange(*keys)
    ranged = _written(dealt.withColumn("_range", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    begins = ranged.groupBy(F.col("_range").alias("_in")).agg(F.count(F.lit(1)).alias("_n"))
    begins = begins.select("_in", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    counted = ranged.withColumn("_nth", inside).join(begins, F.col("_range") == F.col("_in"))
    number = (F.col("_begin") + F.col("_nth") - 1).cast("bigint")
    return counted.select(*[F.col(f"`{c}`") for c in df.columns], number.alias(into))
