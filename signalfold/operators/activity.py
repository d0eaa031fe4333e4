"""Event activity: the common input of the usage, retention and crash reports.

``activity`` has one row per event; ``device_days`` adds it up per day, device and segment. The
reports take either: they only sum the counts and count distinct devices, so a report over the
rolled-up table equals the report over the events, and one scan of the events can serve them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.functions.expressions import event_date, is_fatal, is_type
from signalfold.schema import SEGMENT

KEYS = ("date", "device_id", "region", *SEGMENT)
COUNTS = ("events", "crashes", "fatal_crashes")


def activity(events: DataFrame) -> DataFrame:
    crash = is_type("crash_event")
    return events.select(
        event_date().alias("date"),
        "device_id",
        "region",
        *SEGMENT,
        F.lit(1).cast("bigint").alias("events"),
        F.when(crash, 1).otherwise(0).cast("bigint").alias("crashes"),
        F.when(crash & is_fatal(), 1).otherwise(0).cast("bigint").alias("fatal_crashes"),
    )


def device_days(activity_df: DataFrame) -> DataFrame:
    """Counts per day, device, region and segment. Tasks add up before the shuffle, so a device
    with a third of all events is still a few rows per task."""
    return activity_df.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])
