"""Device retention by cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalfold.functions.expressions import bucket_start, event_date, ratio


def device_first_seen(events: DataFrame) -> DataFrame:
    """``device_id, first_seen``."""
    return events.groupBy("device_id").agg(F.min(event_date()).alias("first_seen"))


def retention_cohorts(events: DataFrame, cohort_days: int = 7, ordered: bool = True) -> DataFrame:
    """``first_seen, cohort_bucket, retained_users``: devices active in each ``cohort_days``-day
    bucket after their first day. Unknown devices cannot return and are left out."""
    active = events.select("device_id", event_date().alias("date"))
    retained = cohorts_from_activity(active, cohort_days)
    return retained.orderBy("first_seen", "cohort_bucket") if ordered else retained


def cohorts_from_activity(active: DataFrame, cohort_days: int = 7) -> DataFrame:
    """One shuffle of the devices: each task gathers a device's distinct days, and these small sets, at most a
    day per calendar day, are merged per device. First day and buckets follow from the set."""
    days = active.where(F.col("device_id").isNotNull()).groupBy("device_id").agg(F.collect_set("date").alias("days"))
    first = days.select(F.array_min("days").alias("first_seen"), "days").where("first_seen is not null")
    buckets = F.transform("days", lambda day: bucket_start(F.datediff(day, F.col("first_seen")), cohort_days))
    return (
        first.select("first_seen", F.explode(F.array_distinct(buckets)).alias("cohort_bucket"))
        .groupBy("first_seen", "cohort_bucket")
        .agg(F.count("*").alias("retained_users"))
    )


def retention_rates(events: DataFrame, cohort_days: int = 7, ordered: bool = True) -> DataFrame:
    """:func:`retention_cohorts` plus ``cohort_size`` and ``retention_rate``."""
    rates = rates_from_cohorts(retention_cohorts(events, cohort_days, ordered=False))
    return rates.orderBy("first_seen", "cohort_bucket") if ordered else rates


def rates_from_cohorts(cohorts: DataFrame) -> DataFrame:
    """Every device is active on its first day, so the cohort's size is its bucket 0."""
    at_start = F.when(F.col("cohort_bucket") == 0, F.col("retained_users"))
    size = F.max(at_start).over(Window.partitionBy("first_seen"))
    return cohorts.withColumn("cohort_size", size).withColumn(
        "retention_rate", ratio(F.col("retained_users"), F.col("cohort_size"))
    )
