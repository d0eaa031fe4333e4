"""Crash rates by segment (device type, OS, app version)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.functions.expressions import ratio
from signalfold.operators.activity import activity
from signalfold.schema import SEGMENT


def crash_analysis(events: DataFrame, ordered: bool = True) -> DataFrame:
    """``device_type, os, app_version, crash_count, affected_devices, fatal_crashes, total_devices,
    crash_rate``: per segment with a crash; the rate is of devices, not of events."""
    analysis = crashes_from_activity(activity(events))
    return analysis.orderBy(F.desc("crash_count"), *SEGMENT) if ordered else analysis


def crashes_from_activity(activity_df: DataFrame) -> DataFrame:
    """One pass: counts per segment and device first, segments after. Crashes and segment sizes
    come out of the same groups, so nothing is joined and no row is expanded for a second distinct.
    A segment with an unknown part has no population to compare with: its total and rate are null.
    """
    known = F.lit(True)
    for part in SEGMENT:
        known = known & F.col(part).isNotNull()
    return (
        segment_devices(activity_df)
        .groupBy(*SEGMENT)
        .agg(
            F.sum("crashes").alias("crash_count"),
            F.count(F.when(F.col("crashes") > 0, F.col("device_id"))).alias("affected_devices"),
            F.sum("fatal_crashes").alias("fatal_crashes"),
            F.count("device_id").alias("_devices"),
        )
        .where(F.col("crash_count") > 0)
        .withColumn("total_devices", F.when(known, F.col("_devices")))
        .withColumn("crash_rate", ratio(F.col("affected_devices"), F.col("total_devices")))
        .drop("_devices")
    )


def segment_devices(activity_df: DataFrame) -> DataFrame:
    """Crash counts per segment and device."""
    return activity_df.groupBy(*SEGMENT, "device_id").agg(
        F.sum("crashes").alias("crashes"), F.sum("fatal_crashes").alias("fatal_crashes")
    )


def segment_population(events: DataFrame) -> DataFrame:
    """``device_type, os, app_version, total_devices``."""
    return events.groupBy(*SEGMENT).agg(F.countDistinct("device_id").alias("total_devices"))


def top_crash_segments(analysis: DataFrame, n: int | None = None) -> DataFrame:
    """Segments by crashes, most first; ties go by segment. All of them, or the first ``n``."""
    ranked = analysis.orderBy(F.desc("crash_count"), *SEGMENT)
    return ranked if n is None else ranked.limit(n)
