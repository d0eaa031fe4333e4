"""Roll-ups as tables bucketed by device: reports that group or join by device need no shuffle of devices.

A table has a folder per day, and in it one file per bucket, sorted by device. All tables of a lake have the same
number of buckets, so they can be joined by device as they lie. They are filled from the stored roll-ups, day by day.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalfold.plans.catalog import sql_session
from signalfold.settings import LakeSettings
from signalfold.sinks.versions import exists

# --- fixed values: columns of the roll-ups by device ---------------------------
DEVICE_TABLES = {
    "device_days": (
        "device_id STRING, region STRING, device_type STRING, os STRING, app_version STRING, "
        "events BIGINT, crashes BIGINT, fatal_crashes BIGINT, date DATE"
    ),
    "feature_days": (
        "device_id STRING, feature_name STRING, uses BIGINT, duration_sum DOUBLE, duration_count BIGINT, "
        "interaction_sum DOUBLE, interaction_count BIGINT, date DATE"
    ),
}
# -----------------------------------------------------------------------------


def table_name(name: str, lake: LakeSettings) -> str:
    return f"{lake.database}.{name}_by_device"


def register_device_tables(spark: SparkSession, lake: LakeSettings = LakeSettings()) -> list[str]:
    """Create the tables, or make those that are stored already known to this catalog; their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.database}")
    names = []
    for name, columns in DEVICE_TABLES.items():
        table, path = table_name(name, lake), f"{lake.device_tables}/{name}"
        if not spark.catalog.tableExists(table):
            stored = exists(spark, path)
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (date) "
                f"CLUSTERED BY (device_id) SORTED BY (device_id) INTO {lake.device_buckets} BUCKETS LOCATION '{path}'"
            )
            if stored:
                spark.sql(f"MSCK REPAIR TABLE {table}")
        names.append(table)
    return names


def extend_device_tables(spark: SparkSession, lake: LakeSettings = LakeSettings(), days: Collection[date] | None = None) -> None:
    """Put the stored roll-ups of ``days`` (all without it) in place of what the tables hold of these days. Running again gives the
    same; other days are neither read nor written. Each task writes one bucket, so a day has one file per bucket."""
    register_device_tables(spark, lake)
    # a session of its own, so that the caller's keeps its setting
    session = sql_session(spark, lake.database)
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    for name, columns in DEVICE_TABLES.items():
        path = f"{lake.rollups}/{name}"
        if not exists(spark, path):
            continue
        rows = session.read.schema(columns).parquet(path)
        if days is not None:
            rows = rows.where(F.col("date").isin(*days))
        table = table_name(name, lake)
        dealt = rows.select(session.table(table).columns).repartition(lake.device_buckets, "device_id")
        dealt.sortWithinPartitions("date", "device_id").write.mode("overwrite").insertInto(table)
        spark.catalog.refreshTable(table)


def analyze_device_tables(spark: SparkSession, lake: LakeSettings = LakeSettings()) -> None:
    """Row counts and the statistics of the device column for the optimizer. Reads that column of all days."""
    for name in DEVICE_TABLES:
        spark.sql(f"ANALYZE TABLE {table_name(name, lake)} COMPUTE STATISTICS FOR COLUMNS device_id")


def device_table(spark: SparkSession, name: str, lake: LakeSettings = LakeSettings()) -> DataFrame:
    """A table as the reports over roll-ups take it (``cohorts_from_activity``, ``crashes_from_activity``, ...)."""
    return spark.table(table_name(name, lake))


def features_of_crashed(spark: SparkSession, lake: LakeSettings = LakeSettings()) -> DataFrame:
    """``feature_name, users, crashed_users``: per feature the devices that used it, and those of them that had a crash on any
    day. Both tables are joined by device as they lie."""
    used = device_table(spark, "feature_days", lake).where("device_id IS NOT NULL").groupBy("device_id", "feature_name").agg(F.count("*").alias("_n"))
    crashed = device_table(spark, "device_days", lake).groupBy("device_id").agg((F.sum("crashes") > 0).alias("_crashed"))
    return (
        used.join(crashed, "device_id", "left")
        .groupBy("feature_name")
        .agg(F.count("*").alias("users"), F.count_if("_crashed").alias("crashed_users"))
    )
