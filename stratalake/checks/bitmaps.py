"""Key checks of dense integer keys from bitmaps.

Keys are dealt into buckets of 32,768 neighbouring numbers, and a bucket's keys are bits of four kilobytes, put together in
the input tasks. So what is shuffled is one bitmap per bucket and task, whatever the number of rows. Bitmaps say exactly
how many keys there are, and in which buckets some are repeated or missing; rows are looked at in those buckets alone.

Meant for keys that are numbered, as order and line numbers are: of keys spread over all
64 bits each would be a bucket of its own, and ``groups.unique`` and ``compare.orphan_counts`` give the same
answers from rows. NULL keys are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.checks import compare, groups
from stratalake.session import scratch_path


def _bucket(key: Column) -> Column:
    return F.bitmap_bucket_number(key)


def key_bitmaps(df: DataFrame, column: str) -> DataFrame:
    """For each ``bucket`` of keys: ``n_rows``, and the keys as ``bits``."""
    key = F.col(column).cast("bigint")
    placed = df.select(_bucket(key).alias("bucket"), F.bitmap_bit_position(key).alias("_position")).filter("bucket IS NOT NULL")
    return placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"), F.bitmap_construct_agg("_position").alias("bits"))


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """One row: ``n_rows`` with a key, and ``n_keys``, the number of different ones."""
    total = [F.sum("n_rows").alias("n_rows"), F.sum(F.bitmap_count("bits")).alias("n_keys")]
    return key_bitmaps(df, column).agg(*[F.coalesce(t, F.lit(0)).alias(n) for t, n in zip(total, ("n_rows", "n_keys"))])


def _in_buckets(df: DataFrame, column: str, buckets: DataFrame) -> DataFrame:
    """The rows whose keys are in listed buckets."""
    listed = buckets.select(F.col("bucket").alias("_listed"))
    return df.join(listed, _bucket(F.col(column).cast("bigint")) == F.col("_listed"), "left_semi")


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unique(df: DataFrame, column: str) -> DataFrame:
    """The rows of ``groups.unique``: keys that occur more than once, with their counts."""
    repeated = key_bitmaps(df, column).filter(F.col("n_rows") > F.bitmap_count("bits")).select("bucket")
    return groups.unique(_in_buckets(df, column, _written(repeated, "repeated-keys")), column)


def orphan_counts(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    from_condition: str | Column = "true",
    to_condition: str | Column = "true",
) -> DataFrame:
    """The rows of ``compare.orphan_counts``: child keys without a parent, with their rows counted."""
    children, parents = child.filter(from_condition), parent.filter(to_condition)
    known = key_bitmaps(parents, field).select("bucket", "bits", F.lit(True).alias("_known"))
    asked = key_bitmaps(children, column).select("bucket", "bits", F.lit(False).alias("_known"))
    # All keys of a bucket are more than the parents' where the children have others.
    both = known.unionAll(asked).groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("_all"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.bitmap_count("bits"))), F.lit(0)).alias("_parents"),
    )
    missing = _written(both.filter("_all > _parents").select("bucket"), "missing-keys")
    return compare.orphan_counts(
        _in_buckets(children, column, missing), column, _in_buckets(parents, field, missing), field
    )
