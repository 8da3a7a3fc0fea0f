"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Timestamps are zone-less end to end, so the session zone only matters for clock values.
# Adaptive execution picks join strategies from measured sizes, splits hot join partitions
# and hot output partitions, and merges small ones.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A local session without that setting uses a folder below its SQL warehouse; on a cluster, where
    that may be a folder of one machine, the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call has been given."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Everything derived from the result sees the same rows, survives the loss of executors
    without recomputation, and keeps column pruning and size statistics.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
