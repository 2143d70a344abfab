"""Union of tables with differing columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Fixed value: default name of the column that says which table a row is from.
SOURCE_COLUMN = "_dbt_source_relation"


def union_relations(
    relations: Sequence[tuple[str, DataFrame]],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = SOURCE_COLUMN,
    where: str | Column | None = None,
) -> DataFrame:
    """All rows of all relations, columns matched by name.

    Columns come in the order they are first seen and have the type of their
    first holder, unless overridden; a relation without a column gives NULL.
    ``where`` filters every branch on the branch's own columns.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    if not relations:
        raise ValueError("no relations to union")
    included = {name.lower() for name in include}
    excluded = {name.lower() for name in exclude}
    overrides = {name.lower(): ddl for name, ddl in (column_override or {}).items()}

    superset: dict[str, tuple[str, DataType]] = {}
    for _, df in relations:
        for field in df.schema.fields:
            key = field.name.lower()
            if key in excluded or (included and key not in included):
                continue
            superset.setdefault(key, (field.name, field.dataType))
    if not superset:
        raise ValueError(f"no columns left to union for {[name for name, _ in relations]}")

    def branch(name: str, df: DataFrame) -> DataFrame:
        held = {c.lower() for c in df.columns}
        rows = df if where is None else df.filter(where)
        source = [] if source_column_name is None else [F.lit(name).alias(source_column_name)]
        return rows.select(
            *source,
            *[
                (F.col(f"`{column}`") if key in held else F.lit(None))
                .cast(overrides.get(key, data_type))
                .alias(column)
                for key, (column, data_type) in superset.items()
            ],
        )

    return reduce(DataFrame.unionAll, [branch(name, df) for name, df in relations])
