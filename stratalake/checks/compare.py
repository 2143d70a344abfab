"""Checks that compare two tables.

The sides are tagged, stacked and aggregated on the compared columns. That is
one shuffle of pre-aggregated rows for both directions at once, and no join that
a hot key could unbalance. NULLs are equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.counted import expand_counts
from stratalake.session import scratch_path

CHECKSUM_BUCKETS = 65_536


def _side_counts(
    a: DataFrame, a_columns: Sequence[Column], b: DataFrame, b_columns: Sequence[Column], names: Sequence[str]
) -> DataFrame:
    """Each combination with its number of rows on both sides, ``_a`` and ``_b``."""

    def tagged(df: DataFrame, columns: Sequence[Column], in_a: int) -> DataFrame:
        named = [c.alias(n) for c, n in zip(columns, names)]
        return df.select(*named, F.lit(in_a).alias("_in_a"))

    stacked = tagged(a, a_columns, 1).unionAll(tagged(b, b_columns, 0))
    return stacked.groupBy(*names).agg(
        F.coalesce(F.sum(F.col("_in_a").cast("bigint")), F.lit(0)).alias("_a"),
        F.coalesce(F.sum(F.lit(1).cast("bigint") - F.col("_in_a")), F.lit(0)).alias("_b"),
    )


def equality(a: DataFrame, b: DataFrame, compare_columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows found on one side only, tagged ``a_minus_b`` or ``b_minus_a``."""
    names = list(compare_columns or a.columns)
    columns = [F.col(f"`{n}`") for n in names]
    counts = _side_counts(a, columns, b, columns, names)
    only_a = F.col("_b") == 0
    only_b = F.col("_a") == 0
    which = F.when(only_a, F.lit("a_minus_b")).otherwise(F.lit("b_minus_a"))
    return counts.filter(only_a | only_b).select(which.alias("which_diff"), *columns)


def reconcile(
    a: DataFrame, b: DataFrame, compare_columns: Sequence[str] | None = None, n_buckets: int = CHECKSUM_BUCKETS
) -> DataFrame:
    """The rows of ``equality``, from sums of row hashes where the tables agree.

    Rows are dealt by a hash into buckets, and a bucket of each side is a count and sums of two
    other hashes, in any order: some rows per task in place of all rows. Only rows of buckets
    whose sums differ are compared themselves. Both tables are read before the result is; different
    rows go unseen only if counts and 128 bits of sums agree by chance.
    """
    names = list(compare_columns or a.columns)
    columns = [F.col(f"`{n}`") for n in names]
    # Hashes leave out NULLs, so where they stand is hashed as well.
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    bucket = F.pmod(F.xxhash64(*columns, nulls), F.lit(n_buckets))

    def sums(df: DataFrame, sign: int) -> DataFrame:
        hashes = [F.xxhash64(F.lit(1), nulls, *columns), F.xxhash64(F.lit(2), *reversed(columns), nulls)]
        # Halves of hashes, so that their sums are far from the ends of their type.
        halves = [half for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
        parts = [(value.cast("decimal(20,0)") * sign).alias(f"_s{i}") for i, value in enumerate([F.lit(1), *halves])]
        return df.select(bucket.alias("_bucket"), *parts)

    totals = sums(a, 1).unionAll(sums(b, -1)).groupBy("_bucket").agg(*[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(5)])
    path = scratch_path(a.sparkSession, "checksums")
    totals.filter(" OR ".join(f"_s{i} <> 0" for i in range(5))).select("_bucket").write.parquet(path)
    differ = a.sparkSession.read.schema("_bucket long").parquet(path)
    left, right = (df.select(*columns).join(differ, bucket == F.col("_bucket"), "left_semi") for df in (a, b))
    return equality(left, right, names)


# Failure count of ``equality``: the rows, plus how uneven the two directions are.
EQUALITY_FAILURES = (
    "count(*) + abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a'))"
)


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """(value, num_rows) pairs that only one side has."""
    counts = _side_counts(a, [F.col(column)], b, [F.col(field)], [column])
    sides = F.filter(F.array(F.col("_a"), F.col("_b")), lambda n: n > 0)
    return counts.filter(F.col("_a") != F.col("_b")).select(column, F.explode(sides).alias("num_rows"))


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """The tables, or the groups, with unequal row counts; a missing group counts 0."""
    columns = [F.col(g) for g in group_by]
    counts = _side_counts(a, columns, b, columns, list(group_by))
    difference = F.abs(F.col("_a") - F.col("_b"))
    return counts.filter(difference > 0).select(
        *columns, F.col("_a").alias("count_a"), F.col("_b").alias("count_b"), difference.alias("diff_count")
    )


EQUAL_ROWCOUNT_FAILURES = "sum(diff_count)"


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """The tables, or the groups, where ``a`` does not have fewer rows than ``b``.

    The delta is the surplus of rows, or 1 for equal counts.
    """
    columns = [F.col(g) for g in group_by]
    counts = _side_counts(a, columns, b, columns, list(group_by))
    delta = F.greatest(F.col("_a") - F.col("_b"), F.lit(1).cast("bigint"))
    return counts.filter(F.col("_a") >= F.col("_b")).select(
        *columns,
        F.col("_a").alias("count_our_model"),
        F.col("_b").alias("count_comparison_model"),
        delta.alias("row_count_delta"),
    )


FEWER_ROWS_FAILURES = "sum(row_count_delta)"


def orphan_counts(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    from_condition: str | Column = "true",
    to_condition: str | Column = "true",
) -> DataFrame:
    """Non-NULL child keys without a parent as ``id``, with their rows counted in ``n_rows``."""
    children = child.filter(from_condition).filter(F.col(column).isNotNull())
    parents = parent.filter(to_condition).filter(F.col(field).isNotNull())
    counts = _side_counts(children, [F.col(column)], parents, [F.col(field)], ["id"])
    return counts.filter((F.col("_b") == 0) & (F.col("_a") > 0)).select("id", F.col("_a").alias("n_rows"))


def relationships_where(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    from_condition: str | Column = "true",
    to_condition: str | Column = "true",
) -> DataFrame:
    """One row per child row whose non-NULL key has no parent; both sides filtered first."""
    return expand_counts(orphan_counts(child, column, parent, field, from_condition, to_condition))


ORPHAN_FAILURES = "sum(n_rows)"
