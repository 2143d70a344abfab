"""Layer tables: one Parquet table per model below ``<root>/<layer>/``.

A table's files are in a folder of their own for each version; a small file names the version that counts.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.ranges import value_ranges

ROWS_PER_FILE = 1_000_000
# Names that begin with an underscore are hidden from readers of the folder above.
VERSION = "_version-"
CURRENT = "_current"


def layer_path(root: str, layer: str | None, table: str, default_layer: str = "default") -> str:
    """The path of a table; the layer name is used as it is, or the default when none is given."""
    return f"{root.rstrip('/')}/{(layer or default_layer).strip()}/{table}"


def _partitions_for(rows: int, cores: int) -> int:
    """Files of some hundred megabytes, and a task for each core."""
    return max(math.ceil(rows / ROWS_PER_FILE), cores)


def clustered(
    df: DataFrame, columns: list[str], sample_from: DataFrame | None = None, n_files: int | None = None
) -> DataFrame:
    """Rows laid out by ``columns``, so that file and row-group statistics can skip data.

    Value ranges come from the first column alone, which Spark can read without
    the rest of the plan; ``sample_from`` is a table to take it from instead. Rows
    go straight to the partition of their range, and those of a value that fills several ranges
    are dealt to these, by the rest of the row and the number of the input partition. Both do not depend
    on the order of rows, so a repeated task sends each row to the same place.
    """
    lead, order = columns[0], [F.col(c) for c in columns]
    sampled = (df if sample_from is None else sample_from).select(lead)
    cores = df.sparkSession.sparkContext.defaultParallelism
    ranges = value_ranges(sampled, lead, n_files or _partitions_for(sampled.count(), cores))
    placed = ranges.assign(df, "_target").repartitionById(ranges.n, F.col("_target"))
    return placed.sortWithinPartitions(*order).drop("_target")


def new_version(
    df: DataFrame, path: str, cluster_by: list[str] | None = None, sample_from: DataFrame | None = None
) -> str:
    """Writes the rows as a version of the table that nobody reads yet; returns where."""
    version = f"{path.rstrip('/')}/{VERSION}{uuid.uuid4().hex}"
    laid_out = clustered(df, cluster_by, sample_from) if cluster_by else df
    laid_out.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(version)
    return version


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, hadoop


def switch_to(spark: SparkSession, path: str, version: str) -> None:
    """Readers of the table see this version from now on, in one step.

    The version's name stands in a small file that is replaced by a rename. The version before stays for
    readers that have begun; older ones are deleted.
    """
    path = path.rstrip("/")
    before = _current_name(spark, path)
    fs, pointer, hadoop = _files(spark, f"{path}/{CURRENT}")
    draft = hadoop.Path(f"{path}/{CURRENT}-{uuid.uuid4().hex}")
    name = version.rsplit("/", 1)[-1]
    out = fs.create(draft, True)
    out.write(bytearray(name.encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(draft), fs.makeQualified(pointer), options)
    if before in (None, name):
        return
    folders = {s.getPath().getName(): s for s in fs.listStatus(hadoop.Path(path)) if s.getPath().getName().startswith(VERSION)}
    if before in folders:
        since = folders[before].getModificationTime()
        for found, status in folders.items():
            # A version that another run is writing is younger.
            if found not in (name, before) and status.getModificationTime() < since:
                fs.delete(status.getPath(), True)


def _current_name(spark: SparkSession, path: str) -> str | None:
    fs, pointer, _ = _files(spark, f"{path.rstrip('/')}/{CURRENT}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current_version(spark: SparkSession, path: str) -> str:
    """Where the files of a table are; a table that was written without versions is its folder itself."""
    name = _current_name(spark, path)
    return f"{path.rstrip('/')}/{name}" if name else path


def write_table(
    df: DataFrame, path: str, cluster_by: list[str] | None = None, sample_from: DataFrame | None = None
) -> None:
    """Full refresh of a table, in one step: a write that fails leaves the table as it was."""
    switch_to(df.sparkSession, path, new_version(df, path, cluster_by, sample_from))


def save_as_table(df: DataFrame, layer: str, table: str, cluster_by: list[str] | None = None) -> DataFrame:
    """Full refresh of a catalog table in the database named like the layer.

    The catalog is pointed at the new version once that is written. With other columns than before, the table is made anew.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    name = f"`{layer}`.`{table}`"
    folder = spark.sql(f"DESCRIBE DATABASE `{layer}`").filter("info_name = 'Location'").first()["info_value"]
    path = f"{folder.rstrip('/')}/_{table}"
    version = new_version(df, path, cluster_by)
    if spark.catalog.tableExists(name) and spark.table(name).schema != df.schema:
        spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, source="parquet", schema=df.schema)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    spark.catalog.refreshTable(name)
    switch_to(spark, path, version)
    return spark.table(name)


def save_bucketed(df: DataFrame, layer: str, table: str, key: str, n_buckets: int) -> DataFrame:
    """Full refresh of a catalog table whose rows are dealt into buckets by ``key``, each sorted by it.

    Tables with as many buckets of the same key are joined, and aggregated by it, as they lie. Rows are dealt
    before the write, so that a bucket is one file. The catalog is pointed at the new version once that is written.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    folder = spark.sql(f"DESCRIBE DATABASE `{layer}`").filter("info_name = 'Location'").first()["info_value"]
    path, draft = f"{folder.rstrip('/')}/{table}", f"{table}_{uuid.uuid4().hex}"
    version = f"{path}/{VERSION}{uuid.uuid4().hex}"

    def saved(name: str) -> None:
        writer = dealt.write.format("parquet").option("path", version).bucketBy(n_buckets, key).sortBy(key)
        writer.saveAsTable(f"`{layer}`.`{name}`")

    dealt = df.repartition(n_buckets, F.col(f"`{key}`"))
    name = f"`{layer}`.`{table}`"
    if spark.catalog.tableExists(name):
        same = spark.table(name).schema == df.schema and _buckets_of(spark, name) == (key, n_buckets)
        # The draft is a second name for the files; dropping it leaves them.
        saved(draft)
        if same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
            spark.sql(f"DROP TABLE `{layer}`.`{draft}`")
            spark.catalog.refreshTable(name)
        else:
            spark.sql(f"DROP TABLE {name}")
            spark.sql(f"ALTER TABLE `{layer}`.`{draft}` RENAME TO {name}")
    else:
        saved(table)
    switch_to(spark, path, version)
    return spark.table(name)


def _buckets_of(spark: SparkSession, name: str) -> tuple[str, int] | None:
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in facts:
        return None
    return facts["Bucket Columns"].strip("[]`"), int(facts["Num Buckets"])


def materialize(
    df: DataFrame, path: str, cluster_by: list[str] | None = None, sample_from: DataFrame | None = None
) -> DataFrame:
    """Write the table and read it back; later steps start from the files."""
    write_table(df, path, cluster_by, sample_from)
    return df.sparkSession.read.schema(df.schema).parquet(current_version(df.sparkSession, path))


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(current_version(spark, layer_path(root, layer, table)))


def persistent_view(spark: SparkSession, layer: str, name: str, query: str) -> DataFrame:
    """A view in the database of a layer, for every session that shares the catalog.

    ``query`` is SQL over catalog tables: such a view holds its text, and follows its tables.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS {query}")
    return spark.table(f"`{layer}`.`{name}`")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A view: nothing is computed until it is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
