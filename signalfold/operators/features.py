"""Feature adoption and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalfold.functions.expressions import event_date, is_type, number, ratio
from signalfold.operators.usage import distinct_devices

_SUMS = ("uses", "duration_sum", "duration_count", "interaction_sum", "interaction_count")


def feature_activity(events: DataFrame) -> DataFrame:
    """One row per feature use, with the addends of every figure the feature reports need."""
    duration = number("payload.duration_ms")
    interactions = number("payload.interaction_count")
    return events.where(is_type("feature_used")).select(
        event_date().alias("date"),
        F.col("payload.feature_name").alias("feature_name"),
        "device_id",
        F.lit(1).cast("bigint").alias("uses"),
        duration.alias("duration_sum"),
        F.when(duration.isNotNull(), 1).otherwise(0).cast("bigint").alias("duration_count"),
        interactions.alias("interaction_sum"),
        F.when(interactions.isNotNull(), 1).otherwise(0).cast("bigint").alias("interaction_count"),
    )


def feature_days(feature_df: DataFrame) -> DataFrame:
    """Feature activity added up per day, feature and device."""
    return feature_df.groupBy("date", "feature_name", "device_id").agg(*[F.sum(c).alias(c) for c in _SUMS])


def feature_adoption_rates(events: DataFrame, ordered: bool = True) -> DataFrame:
    """``date, feature_name, unique_users, total_usage, avg_duration_ms, adoption_rate``; the rate
    is over all devices of all events and dates."""
    adoption = adoption_from_activity(feature_activity(events), distinct_devices(events))
    return adoption.orderBy("date", F.desc("unique_users"), "feature_name") if ordered else adoption


def adoption_from_activity(feature_df: DataFrame, devices: DataFrame) -> DataFrame:
    """The device total is a scalar subquery: one number, inside the one plan."""
    return _totals(feature_df, "date", "feature_name").select(
        "date", "feature_name", "unique_users", "total_usage", "avg_duration_ms",
        ratio(F.col("unique_users"), device_total(devices)).alias("adoption_rate"),
    )


def feature_ranking(events: DataFrame, ordered: bool = True) -> DataFrame:
    """``feature_name, unique_users, total_usage, avg_duration_ms, avg_interactions, rank``."""
    ranking = ranking_from_activity(feature_activity(events))
    return ranking.orderBy("rank") if ordered else ranking


def ranking_from_activity(feature_df: DataFrame) -> DataFrame:
    """Ranked by users, then uses, then name, so that ties have one order. The window has no
    partition: its input is one row per feature of the product, not per event."""
    order = Window.orderBy(F.desc("unique_users"), F.desc("total_usage"), F.asc("feature_name"))
    return _totals(feature_df, "feature_name").withColumn("rank", F.row_number().over(order))


def device_total(devices: DataFrame):
    return devices.agg(F.count("*").alias("devices")).scalar()


def _totals(feature_df: DataFrame, *keys: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in _SUMS]
    return (
        feature_df.groupBy(*keys)
        .agg(F.countDistinct("device_id").alias("unique_users"), *sums)
        .select(
            *keys,
            "unique_users",
            F.col("uses").alias("total_usage"),
            ratio(F.col("duration_sum"), F.col("duration_count")).alias("avg_duration_ms"),
            ratio(F.col("interaction_sum"), F.col("interaction_count")).alias("avg_interactions"),
        )
    )
