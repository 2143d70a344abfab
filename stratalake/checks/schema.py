"""Checks on a table's columns, its keys and by free query."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.dates import add_part

NAME_TRANSFORMS: dict[str, Callable[[str], str]] = {"upper": str.upper, "lower": str.lower}


def expect_table_columns_to_match_set(
    df: DataFrame, column_list: Sequence[str], transform: str = "upper"
) -> DataFrame:
    """Column names that only the table or only the list has; case is folded by ``transform``."""
    fold = NAME_TRANSFORMS[transform]
    held = sorted({fold(c) for c in df.columns})
    asked = sorted({fold(c) for c in column_list})
    spark = df.sparkSession
    table_side = spark.createDataFrame([(c,) for c in held], "relation_column string")
    list_side = spark.createDataFrame([(c,) for c in asked], "input_column string")
    paired = table_side.join(list_side, F.col("relation_column") == F.col("input_column"), "full")
    return paired.filter(F.col("relation_column").isNull() | F.col("input_column").isNull())


def custom_query(
    spark: SparkSession,
    query: str,
    relations: Mapping[str, DataFrame] | None = None,
    days_behind: int | None = None,
    as_of: Column | datetime | None = None,
) -> DataFrame:
    """The rows of a query are the violations.

    ``relations`` are named in the query as ``{name}``. With ``days_behind`` the
    relation ``{tmp_variable}`` has one row whose ``begin_date`` lies that many
    days before ``as_of``, or before now.
    """
    named = dict(relations or {})
    if days_behind is not None:
        now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
        named["tmp_variable"] = spark.range(1).select(add_part("day", -days_behind, now).alias("begin_date"))
    return spark.sql(query, **named)
