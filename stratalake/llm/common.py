"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Runs of ASCII characters that are neither letters (lower-cased before) nor digits.
WORD_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none.

    Only the first and the last part of a split can be empty.
    """
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_GAPS)
    return F.filter(parts, lambda word: word != "")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named by their places, so that none is taken for an operator's own, and the new names."""
    names = [f"_{n}" for n in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches a few at a time, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
