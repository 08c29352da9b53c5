"""Session construction and the settings every plan here assumes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Adaptive execution sizes the post-shuffle partitions
# and splits skewed sort-merge joins; broadcasts happen only under Spark's own
# size-checked threshold, never by hint on data that grows.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Feature rows are narrow in the shuffle and wide in the windows, so small
    # partitions still keep the cores busy; the advisory size rules large data.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, memory: str = "8g", app: str = "gavel") -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str | None:
    """The shared folder for checkpoints and working tables, if the cluster names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for a working table: in the shared folder, or in a local
    one where none is set and driver and executors are one process, as in tests."""
    base = shared_dir(spark)
    if base is None:
        if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "gavel-work")
    return f"{base}/gavel/{uuid.uuid4().hex}/{label}"


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` computed once into a working table and read back.

    For results that several branches of a plan need and that are small next
    to the input they come from: without this each branch would scan the input
    again. The table outlives lost executors, and its size is known to the
    planner when it chooses joins.
    """
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
