"""Rows held once with a count of their copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_CHUNK = 65_536


def expand_counts(df: DataFrame, count: str = "n_rows", chunk: int = COPIES_PER_CHUNK) -> DataFrame:
    """Every row as many times as its count says, without the count.

    A large count is first cut into chunks that are shuffled by chunk number, so
    the copies of one row are written out by many tasks.
    """
    others = [c for c in df.columns if c != count]
    chunks = df.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, ({count} - 1) div {chunk})"))).withColumn(
        count, F.expr(f"least({chunk}L, {count} - _chunk * {chunk})")
    )
    spread = chunks.repartition("_chunk", *[F.col(f"`{c}`") for c in others])
    copies = spread.withColumn("_copy", F.explode(F.expr(f"sequence(1L, {count})")))
    return copies.select(*[F.col(f"`{c}`") for c in others])
