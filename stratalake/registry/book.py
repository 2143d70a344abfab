"""A collection of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class QueryBook:
    def __init__(self):
        self.spark: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Decorator: register a query under ``name`` with its SQL, if it has one."""

        def register(query: Query) -> Query:
            if name in self.spark:
                raise ValueError(f"query {name!r} is registered twice")
            self.spark[name] = query
            if sql is not None:
                self.sql[name] = sql.strip()
            return query

        return register

    def include(self, other: QueryBook) -> None:
        for name, query in other.spark.items():
            self.add(name, other.sql.get(name))(query)
