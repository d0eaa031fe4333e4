"""Daily usage: active devices, events, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.functions.expressions import event_date, is_type
from signalfold.operators.activity import activity


def daily_usage_trends(events: DataFrame, ordered: bool = True) -> DataFrame:
    """``date, daily_active_users, total_events, total_sessions``; sessions count app opens only."""
    usage = _usage(events.select(event_date().alias("date"), *_usage_columns()), "date")
    return usage.orderBy("date") if ordered else usage


def hourly_usage_trends(events: DataFrame, ordered: bool = True) -> DataFrame:
    """:func:`daily_usage_trends` by hour; the first column is ``hour``."""
    hour = F.date_trunc("hour", "timestamp").cast(events.schema["timestamp"].dataType)
    usage = _usage(events.select(hour.alias("hour"), *_usage_columns()), "hour")
    return usage.orderBy("hour") if ordered else usage


def _usage_columns() -> list[Column]:
    return [F.col("device_id"), F.when(is_type("app_open"), F.col("payload.session_id")).alias("session_id")]


def _usage(rows: DataFrame, period: str) -> DataFrame:
    return rows.groupBy(period).agg(
        F.countDistinct("device_id").alias("daily_active_users"),
        F.count("*").alias("total_events"),
        F.countDistinct("session_id").alias("total_sessions"),
    )


def daily_sessions(events: DataFrame) -> DataFrame:
    """``date, total_sessions`` of the days that have an app open; reads app opens only."""
    return (
        events.where(is_type("app_open"))
        .groupBy(event_date().alias("date"))
        .agg(F.countDistinct("payload.session_id").alias("total_sessions"))
    )


def usage_from_activity(activity_df: DataFrame, sessions: DataFrame) -> DataFrame:
    """:func:`daily_usage_trends` from activity rows and :func:`daily_sessions`."""
    days = activity_df.groupBy("date").agg(
        F.countDistinct("device_id").alias("daily_active_users"),
        F.sum("events").alias("total_events"),
    )
    same_day = days["date"].eqNullSafe(sessions["date"])
    return days.join(sessions, same_day, "left").select(
        days["date"],
        "daily_active_users",
        "total_events",
        F.coalesce("total_sessions", F.lit(0)).cast("bigint").alias("total_sessions"),
    )


def daily_trends_by_region(events: DataFrame, ordered: bool = True) -> DataFrame:
    """``date, region, daily_active_users, total_events``."""
    trends = regions_from_activity(activity(events))
    return trends.orderBy("date", "region") if ordered else trends


def regions_from_activity(activity_df: DataFrame) -> DataFrame:
    return activity_df.groupBy("date", "region").agg(
        F.countDistinct("device_id").alias("daily_active_users"),
        F.sum("events").alias("total_events"),
    )


def distinct_devices(events: DataFrame) -> DataFrame:
    """Each device once; an unknown (null) device is one row too."""
    return events.select("device_id").distinct()
