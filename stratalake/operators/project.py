"""Column lists made from a table's schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def filtered_columns(df: DataFrame, except_: Sequence[str] = ()) -> list[str]:
    """Column names without the listed ones; case does not matter."""
    unwanted = {name.lower() for name in except_}
    return [name for name in df.columns if name.lower() not in unwanted]


def star(
    df: DataFrame,
    except_: Sequence[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str | None = None,
    quote_identifiers: bool = True,
) -> list[Column]:
    """All columns but the listed ones, renamed only when a prefix or suffix is given."""
    owner = f"{relation_alias}." if relation_alias else ""

    def column(name: str) -> Column:
        return F.col(f"{owner}`{name}`" if quote_identifiers else f"{owner}{name}")

    names = filtered_columns(df, except_)
    if not prefix and not suffix:
        return [column(name) for name in names]
    return [column(name).alias(f"{prefix}{name}{suffix}") for name in names]


def nullcheck(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """The columns with empty text turned into NULL; other types unchanged."""
    wanted = None if columns is None else {name.lower() for name in columns}
    fields = [f for f in df.schema.fields if wanted is None or f.name.lower() in wanted]
    return [
        F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
        if isinstance(f.dataType, StringType)
        else F.col(f"`{f.name}`")
        for f in fields
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))


def group_by_n(df: DataFrame, n: int) -> GroupedData:
    """Grouping by the first ``n`` columns."""
    if not 1 <= n <= len(df.columns):
        raise ValueError(f"n must be between 1 and {len(df.columns)}, got {n}")
    return df.groupBy(*[F.col(f"`{name}`") for name in df.columns[:n]])
