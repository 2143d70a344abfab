"""Finding tables by name pattern in the session catalog."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def _like(pattern: str) -> re.Pattern:
    """A case-insensitive LIKE pattern: ``%`` is any text, ``_`` any one character."""
    wild = {"%": ".*", "_": "."}
    body = "".join(wild.get(ch, re.escape(ch)) for ch in pattern)
    return re.compile(body, re.IGNORECASE | re.DOTALL)


# What each kind of catalog entry is called.
TABLE_TYPES = {"MANAGED": "table", "EXTERNAL": "external", "VIEW": "view", "TEMPORARY": "view"}


@dataclass(frozen=True, order=True)
class Relation:
    """A table or view of the catalog; temporary views have no schema."""

    table_schema: str
    table_name: str
    table_type: str

    @property
    def qualified_name(self) -> str:
        return f"`{self.table_schema}`.`{self.table_name}`" if self.table_schema else f"`{self.table_name}`"


def tables_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> list[Relation]:
    """The tables and views whose database and name match, sorted.

    Only catalog metadata is read. Temporary views belong to no database and are
    listed for the database that is current.
    """
    wanted_schema, wanted, unwanted = _like(schema_pattern), _like(table_pattern), _like(exclude)
    current = spark.catalog.currentDatabase()
    found = set()
    for database in spark.catalog.listDatabases():
        if not wanted_schema.fullmatch(database.name):
            continue
        for table in spark.catalog.listTables(database.name):
            if not wanted.fullmatch(table.name) or unwanted.fullmatch(table.name):
                continue
            kind = TABLE_TYPES.get(table.tableType, table.tableType.lower())
            if not table.isTemporary:
                found.add(Relation(database.name, table.name, kind))
            elif database.name == current:
                found.add(Relation("", table.name, kind))
    return sorted(found)


def relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> list[str]:
    """Their names, as ``spark.table`` and ``union_relations`` take them."""
    return [r.qualified_name for r in tables_by_pattern(spark, schema_pattern, table_pattern, exclude)]


def tables_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[Relation]:
    return tables_by_pattern(spark, schema, f"{prefix}%", exclude)


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[str]:
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def open_relations(spark: SparkSession, names: list[str]) -> list[tuple[str, DataFrame]]:
    """Named DataFrames, in the form that ``union_relations`` takes."""
    return [(name, spark.table(name)) for name in names]
