"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE coalesces shuffle partitions and splits skewed ones; small text files are packed densely
# (the default open cost of 4 MB would give one task per 32 scripts).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.openCostInBytes": str(64 * 1024),
    # Script text grows manyfold when cut into tokens, so small shuffle partitions are kept apart.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}

#: Shuffle files go when their query ends. Without it they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def spread(df: DataFrame) -> DataFrame:
    """Deals rows out to as many tasks as a shuffle has. Text work is heavy for its bytes, and
    file splits do not say how heavy."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="wellspring-")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the cluster's shared scratch space.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _local_dir()
    return f"{base.rstrip('/')}/wellspring-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result is read several times or the plan would otherwise grow without end. The
    files outlive lost executors, and the scan that replaces the plan has true sizes, so Spark
    knows which sides are small enough to broadcast. The shuffle files of the write go with it.
    """
    spark = df.sparkSession
    path, before = work_dir(spark), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
