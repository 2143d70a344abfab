"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on for its behaviour at scale. A session that the
# caller already owns keeps its own values; these apply to sessions built here.
RECOMMENDED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

# Bytes of shuffled data per task. Few enough tasks that the driver can hold the sizes of all
# their blocks, which grow with the square; adaptive execution splits or merges from there.
TARGET_PARTITION_BYTES = 1024 * 1024 * 1024
DEFAULT_SHUFFLE_PARTITIONS = 200
SCRATCH = "stratalake-scratch"


def shuffle_partitions_for(data_bytes: int) -> int:
    """Shuffle partitions for a table of this size; adaptive execution merges those that stay small."""
    return max(DEFAULT_SHUFFLE_PARTITIONS, math.ceil(data_bytes / TARGET_PARTITION_BYTES))


def build_session(
    app_name: str = "stratalake", master: str | None = None, data_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the recommended settings; ``conf`` entries win over them.

    ``data_bytes`` is the size of the largest table to be shuffled.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    if data_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(data_bytes))
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _scratch_root(spark: SparkSession) -> str:
    """The folder of this application's tables, below one that all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{SCRATCH}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path for an intermediate table in the folder shared by all executors.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a local session takes one
    below the warehouse, and a cluster's raises. ``remove_scratch`` takes this application's tables away.
    """
    return f"{_scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Removes the tables of this application's runs; results that still read them can no longer be computed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
