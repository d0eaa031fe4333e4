"""Event-time window aggregates; every function takes batch and streaming input alike.

Distinct counting on a stream takes two steps: count per window, key and device, then per window
and key. Both are hash aggregates with a partial step before the shuffle, so a hot device, feature
or region is one row per task, and the state of step one is one row per device of the open windows.
The stages run in append mode: a window is written once, when the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.functions.expressions import is_type, ratio


def windowed(
    events: DataFrame, width: str, keys: Sequence[str], counts: dict[str, Column] | None = None
) -> DataFrame:
    """Step one: per window, keys and device the rows (``n``) and the rows that meet each condition
    of ``counts``."""
    conditions = [F.count_if(condition).alias(name) for name, condition in (counts or {}).items()]
    return events.groupBy(F.window("timestamp", width), *keys, "device_id").agg(
        F.count("*").alias("n"), *conditions
    )


def _only(events: DataFrame, event_type: str) -> DataFrame:
    """Rows of one type. On a stream the condition mentions the event time: Spark moves a filter that
    does not below the watermark, which would then wait for rows of that type, and in quiet times
    the last windows with it. On a batch the plain condition reaches the scan."""
    if not events.isStreaming:
        return events.where(is_type(event_type))
    return events.where(F.col("event_type") == F.when(F.col("timestamp").isNotNull(), event_type))


def _with_bounds(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns
    )


def tumbling_counts(events: DataFrame, width: str) -> DataFrame:
    """``window_start, window_end, event_count`` of tumbling windows."""
    return _with_bounds(
        events.groupBy(F.window("timestamp", width)).agg(F.count("*").alias("event_count")), "event_count"
    )


def active_users_per_minute(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """``window_start, window_end, region, device_type, active_users, event_count``."""
    counted = windowed(events, width, ["region", "device_type"]).groupBy("window", "region", "device_type").agg(
        F.count("device_id").alias("active_users"), F.sum("n").alias("event_count")
    )
    return _with_bounds(counted, "region", "device_type", "active_users", "event_count")


def error_spikes(events: DataFrame, width: str = "30 seconds") -> DataFrame:
    """``window_start, window_end, os, app_version, crash_count, affected_devices``."""
    crashes = _only(events, "crash_event")
    counted = windowed(crashes, width, ["os", "app_version"]).groupBy("window", "os", "app_version").agg(
        F.sum("n").alias("crash_count"), F.count("device_id").alias("affected_devices")
    )
    return _with_bounds(counted, "os", "app_version", "crash_count", "affected_devices")


def feature_usage(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """``window_start, window_end, feature_name, usage_count, unique_users``."""
    uses = _only(events, "feature_used").withColumn("feature_name", F.col("payload.feature_name"))
    counted = windowed(uses, width, ["feature_name"]).groupBy("window", "feature_name").agg(
        F.sum("n").alias("usage_count"), F.count("device_id").alias("unique_users")
    )
    return _with_bounds(counted, "feature_name", "usage_count", "unique_users")


def spike_alerts(events: DataFrame, max_error_rate: float = 0.05, width: str = "30 seconds") -> DataFrame:
    """:func:`error_spikes` with ``event_count``, ``error_rate`` and ``is_spike`` (rate above the
    threshold); windows without a crash are left out."""
    per_device = windowed(events, width, ["os", "app_version"], {"crashes": is_type("crash_event")})
    counted = (
        per_device.groupBy("window", "os", "app_version")
        .agg(
            F.sum("crashes").alias("crash_count"),
            F.count(F.when(F.col("crashes") > 0, F.col("device_id"))).alias("affected_devices"),
            F.sum("n").alias("event_count"),
        )
        .where(F.col("crash_count") > 0)
        .withColumn("error_rate", ratio(F.col("crash_count"), F.col("event_count")))
        .withColumn("is_spike", F.col("error_rate") > F.lit(float(max_error_rate)))
    )
    return _with_bounds(
        counted, "os", "app_version", "crash_count", "affected_devices", "event_count", "error_rate", "is_spike"
    )
