"""Zone maps: the least and greatest key of each file of a table, by which a reader chooses files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.ordered import with_neighbour
from stratalake.sources.layers import current_version

ZONES = "_zones-"


def _zones_path(version: str, column: str) -> str:
    """Inside the folder of the table's version, hidden from its readers, and gone with it."""
    return f"{version}/{ZONES}{column}"


def write_zone_map(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Reads the column once and keeps ``file``, ``n_rows``, ``n_null``, ``least`` and ``greatest`` for each file."""
    version = current_version(spark, path)
    key = F.col(f"`{column}`")
    zones = (
        spark.read.parquet(version)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(key.isNull()).alias("n_null"),
            F.min(key).alias("least"),
            F.max(key).alias("greatest"),
        )
    )
    zones.write.mode("overwrite").parquet(_zones_path(version, column))
    return read_zone_map(spark, path, column)


def read_zone_map(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.parquet(_zones_path(current_version(spark, path), column))


def overlapping_files(zones: DataFrame) -> DataFrame:
    """Files whose keys reach beyond the least key of the next file; those that share one key at their ends do not."""
    keyed = zones.filter("least IS NOT NULL").select("least", "greatest", "file", "n_rows")
    following = with_neighbour(keyed, "least", "next_least", "next", then_by=["greatest"], in_ranges=True)
    return following.filter("next_least < greatest").select("file", "n_rows", "least", "greatest", "next_least")


def read_range(spark: SparkSession, path: str, column: str, low=None, high=None) -> DataFrame:
    """Rows with keys from ``low`` to ``high``, both included, from the files that can hold any; NULL keys are in no range.

    The names of those files are all that the driver gets, as with any list of files that it reads.
    """
    version = current_version(spark, path)
    zones = read_zone_map(spark, path, column)
    key = F.col(f"`{column}`")
    in_file, in_row = F.col("least").isNotNull(), key.isNotNull()
    if low is not None:
        in_file, in_row = in_file & (F.col("greatest") >= F.lit(low)), in_row & (key >= F.lit(low))
    if high is not None:
        in_file, in_row = in_file & (F.col("least") <= F.lit(high)), in_row & (key <= F.lit(high))
    files = [row["file"] for row in zones.filter(in_file).select("file").toLocalIterator()]
    schema = spark.read.parquet(version).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.filter(in_row)
