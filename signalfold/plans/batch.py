"""The batch layer: all reports of one set of events.

The roll-ups are tables of the lake, with a folder per day: device-days, feature-device-days, the sessions per day, quantile sketches of
the performance samples and distinct sketches of the devices. A run adds the days of its events, or replaces them, and
leaves the other days as they are, so history is scanned once and not by every run. All reports run over the roll-ups.
The active days of each device are kept as bits besides, in folders of 64 days.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from signalfold.functions.expressions import event_date
from signalfold.operators.activity import activity, device_days
from signalfold.operators.crashes import crashes_from_activity
from signalfold.operators.device_bitmaps import bitmaps, extended
from signalfold.operators.features import (
    adoption_from_activity, feature_activity, feature_days, ranking_from_activity,
)
from signalfold.operators.performance import device_performance_report, performance_by_metric
from signalfold.operators.retention import cohorts_from_activity
from signalfold.operators.sketches import active_days, performance_days, performance_from_days
from signalfold.operators.usage import (
    daily_sessions, distinct_devices, regions_from_activity, usage_from_activity,
)
from signalfold.schema import SEGMENT
from signalfold.session import workspace
from signalfold.settings import LakeSettings, Settings
from signalfold.sinks.batch import exists, write_partitioned, write_reports


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared work folder, read back from there."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# what makes each roll-up, and the roll-ups that each report is made of
ROLL_UPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "device_days": lambda events: device_days(activity(events)),
    "feature_days": lambda events: feature_days(feature_activity(events)),
    "session_days": daily_sessions,
    "performance_days": performance_days,
    "active_days": active_days,
}
REPORT_ROLL_UPS = {
    "daily_trends": ("device_days", "session_days"),
    "regional_trends": ("device_days",),
    "feature_adoption": ("feature_days", "device_days"),
    "feature_ranking": ("feature_days",),
    "retention_cohorts": ("device_days",),
    "device_performance": ("performance_days",),
    "performance_by_metric": ("performance_days",),
    "crash_analysis": ("device_days",),
}


def roll_ups(events: DataFrame, names: Iterable[str] = tuple(ROLL_UPS)) -> dict[str, DataFrame]:
    """The named roll-ups of some events; each has a ``date``."""
    return {name: ROLL_UPS[name](events) for name in names}


def extend_roll_ups(events: DataFrame, lake: LakeSettings, names: Iterable[str] = tuple(ROLL_UPS)) -> dict[str, DataFrame]:
    """Store the roll-ups of the days that ``events`` have, whole days, in place of what is stored of these days, and
    return the roll-ups of all days. Events without a date are a day of their own."""
    spark, stored_days = events.sparkSession, {}
    for name, table in roll_ups(events, names).items():
        path = f"{lake.rollups}/{name}"
        write_partitioned(table, path, "date", mode="overwrite")
        stored_days[name] = spark.read.schema(table.schema).parquet(path).select(table.columns)
    return stored_days


def extend_bitmaps(active: DataFrame, lake: LakeSettings) -> DataFrame:
    """Store the device bitmaps with the days of ``active`` (``device_id, date``; whole days) in place of what they said of these days,
    and return all. Only the folders of the 64 days around these days are read and written. Running again gives the same."""
    spark, path = active.sparkSession, f"{lake.rollups}/device_bitmaps"
    new = bitmaps(active)
    if exists(spark, path):
        new = extended(spark.read.schema(new.schema).parquet(path), active)
    # the folders that are replaced are read as well
    write_partitioned(stored(new, "bitmaps"), path, "period", mode="overwrite")
    return spark.read.schema(new.schema).parquet(path).select(new.columns)


def reports(
    events: DataFrame, settings: Settings = Settings(), rolled: dict[str, DataFrame] | None = None, names: Iterable[str] = tuple(REPORT_ROLL_UPS)
) -> dict[str, DataFrame]:
    """The seven reports and the performance report by metric, or those named. With stored roll-ups ``rolled``, the reports
    are over those, else each is a plan over the events."""
    if rolled:
        days, features, sessions = (rolled.get(name) for name in ("device_days", "feature_days", "session_days"))
        samples = rolled.get("performance_days")
        performance = lambda *keys: performance_from_days(samples, *keys)
    else:
        days, features, sessions = activity(events), feature_activity(events), daily_sessions(events)
        performance = lambda *keys: (performance_by_metric if "metric_name" in keys else device_performance_report)(events, ordered=False)
    made = {
        "daily_trends": lambda: usage_from_activity(days, sessions),
        "regional_trends": lambda: regions_from_activity(days),
        "feature_adoption": lambda: adoption_from_activity(features, distinct_devices(days)),
        "feature_ranking": lambda: ranking_from_activity(features),
        "retention_cohorts": lambda: cohorts_from_activity(days, settings.cohort_days),
        "device_performance": lambda: performance(*SEGMENT),
        "performance_by_metric": lambda: performance(*SEGMENT, "metric_name"),
        "crash_analysis": lambda: crashes_from_activity(days),
    }
    return {name: made[name]() for name in names}


def run_batch(events: DataFrame, settings: Settings = Settings(), new_days: DataFrame | None = None, names: Iterable[str] = tuple(REPORT_ROLL_UPS)) -> None:
    """Compute all reports of ``events``, or those named, and write each below the lake's batch folder.

    ``new_days`` are the events of the days that the roll-ups don't hold yet or hold in part; without it, all.
    """
    names = tuple(names)
    needed = ROLL_UPS if set(names) == set(REPORT_ROLL_UPS) else dict.fromkeys(r for name in names for r in REPORT_ROLL_UPS[name])
    new = events if new_days is None else new_days
    rolled = extend_roll_ups(new, settings.lake, needed)
    if len(needed) == len(ROLL_UPS):
        extend_bitmaps(new.select("device_id", event_date().alias("date")), settings.lake)
    write_reports(reports(events, settings, rolled, names), settings.lake.batch)
