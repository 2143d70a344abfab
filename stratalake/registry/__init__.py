"""Every query that can be run by name, each with the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.registry import check_queries, model_queries, operator_queries
from stratalake.registry.book import QueryBook

ALL = QueryBook()
for module in (model_queries, operator_queries, check_queries):
    ALL.include(module.BOOK)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(ALL.spark)


def oracle_sql() -> dict[str, str]:
    return dict(ALL.sql)
