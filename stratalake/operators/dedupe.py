"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deduplicate(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]
) -> DataFrame:
    """The first full row of each key under ``order_by``; NULL keys form one group.

    Pass a total order to make the choice repeatable. Catalyst keeps only the
    first row of a key in every input task before the shuffle (a partial
    WindowGroupLimit), so a hot key arrives as one row per task.
    """
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_position", F.row_number().over(window)).filter("_position = 1").drop("_position")
