"""Spark sessions for the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "wayspan", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins, dynamic partition overwrite."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # object stores: requests that fail are made again, and enough connections for a task's columns
        "spark.hadoop.fs.s3a.attempts.maximum": "8",
        "spark.hadoop.fs.s3a.retry.limit": "7",
        "spark.hadoop.fs.s3a.connection.maximum": "64",
    }
    if shuffle_partitions:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
