"""Comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(directory: str):
    con = duckdb.connect()
    for path in sorted(Path(directory).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return str([_plain(v) for v in value])
    return "NULL" if value is None else repr(value)


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs, as short messages; empty when the results are equal."""
    relation = con.sql(sql)
    spark_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    duck_types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    found = []
    if sorted(spark_types) != sorted(duck_types):
        return [f"columns {sorted(spark_types)} != {sorted(duck_types)}"]
    for name, spark_type in spark_types.items():
        expected = DUCK_TYPES.get(spark_type)
        if expected and expected != duck_types[name]:
            found.append(f"type of {name}: {spark_type} != {duck_types[name]}")
    ours = _canonical(spark_df.columns, spark_df.collect())
    theirs = _canonical(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    for mine, other in zip(ours, theirs):
        if mine != other:
            found.append(f"first difference {mine} != {other}")
            break
    return found
