"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set by build_session() only where the caller's cluster has not set them.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Lets "row_number() <= 2000" be cut on the map side; Spark's own limit for this is 1000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "cellspark", **conf: str) -> SparkSession:
    """Return a session with the defaults above; ``conf`` overrides them (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without one: it then gets a temporary folder that goes with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _local_scratch()
    return os.path.join(root, "cellspark", f"{name}-{uuid.uuid4().hex}")


@functools.cache
def _local_scratch() -> str:
    folder = tempfile.TemporaryDirectory(prefix="cellspark-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    return folder.name


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a table that is read several times to the shared folder and read it back.

    Cuts the lineage without relying on any one executor staying alive.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
