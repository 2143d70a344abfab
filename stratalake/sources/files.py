"""CSV and Parquet readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.schemas import SOURCE_COLUMNS, text_schema


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def _strict_csv(spark: SparkSession):
    # One record per line, so that Spark can split large files; a row with a
    # missing or an extra field stops the job. A doubled quote stands for a quote.
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", False)
        .option("mode", "FAILFAST")
    )


def read_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file or folder under a declared all-text schema.

    Spark reads an empty field as NULL; later layers test for the empty string,
    so it is restored here and nowhere else.
    """
    raw = _strict_csv(spark).schema(text_schema(columns)).csv(path)
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def source(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A named raw source, stored as ``<directory>/<name>.csv`` (a file or a folder)."""
    if name not in SOURCE_COLUMNS:
        raise KeyError(f"unknown source {name!r}; declared: {sorted(SOURCE_COLUMNS)}")
    return read_text_csv(spark, f"{directory.rstrip('/')}/{name}.csv", SOURCE_COLUMNS[name])


def write_text_csv(df: DataFrame, path: str) -> None:
    """The inverse of :func:`read_text_csv`; empty strings are written as quoted empties."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def typed_load(
    spark: SparkSession,
    path: str,
    columns: list[str],
    column_types: dict[str, str] | None = None,
    infer_others: bool = False,
) -> DataFrame:
    """A CSV with an optional type per column; columns without one stay text.

    Empty fields are NULL. A value that does not fit its type stops the job.
    ``infer_others`` takes the types of the other columns from the values, which
    reads the file one time more.
    """
    types = {name.lower(): ddl for name, ddl in (column_types or {}).items()}
    unknown = set(types) - {c.lower() for c in columns}
    if unknown:
        raise ValueError(f"types given for unknown columns: {sorted(unknown)}")
    if infer_others:
        found = _strict_csv(spark).option("inferSchema", True).csv(path).toDF(*columns)
        types = {f.name.lower(): f.dataType for f in found.schema.fields} | types
    raw = _strict_csv(spark).schema(text_schema(columns)).csv(path)
    return raw.select(*[F.col(c).cast(types.get(c.lower(), "string")).alias(c) for c in columns])
