"""Session construction and the durable work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SHUFFLE_PARTITIONS = 1024


def build_session(
    app_name: str = "signalfold", master: str | None = None, shuffle_partitions: int = SHUFFLE_PARTITIONS, **conf: object
) -> SparkSession:
    """A session with UTC time, AQE and skew-join splitting on. Executor sizes are left to
    spark-submit; ``conf`` keys may use ``__`` for ``.``.

    Shuffles start with ``shuffle_partitions`` parts, a fixed number and not one of the cores that happen
    to be registered; AQE merges what turns out too small. Raise it for shuffles of many terabytes.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # fewer, larger scan tasks over very large tables
        .config("spark.sql.files.maxPartitionBytes", "256m")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, empty path in the shared folder named by ``spark.checkpoint.dir``, or else in the
    warehouse, which is always set and which all executors of a cluster share too."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
