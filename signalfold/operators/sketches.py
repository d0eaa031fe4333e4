"""Percentiles and distinct devices of any days, from mergeable sketches stored by day.

A day's events are read once, when the day is added. Quantile sketches (KLL) hold all values up to their parameter and are
exact until then; beyond it a rank is off by at most about ``RANK_ERROR``. Distinct sketches (HLL) of ``LG_K`` bits have a relative
standard error of ``DEVICE_ERROR``, and are all but exact for up to some thousand devices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.functions.expressions import event_date, is_type, number
from signalfold.schema import SEGMENT

KLL_K = 4096
RANK_ERROR = 0.0025
LG_K = 16
DEVICE_ERROR = 1.04 / 2 ** (LG_K / 2)
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def performance_days(events: DataFrame) -> DataFrame:
    """``date``, segment, ``metric_name``, ``sketch`` of the values, ``total``, ``value_count`` (values that are numbers) and
    ``sample_count`` (all samples). Tasks make a sketch per group, and these are merged, so a hot metric is a few rows."""
    value = number("payload.value").alias("value")
    samples = events.where(is_type("performance_metric")).select(
        event_date().alias("date"), *SEGMENT, F.col("payload.metric_name").alias("metric_name"), value
    )
    return samples.groupBy("date", *SEGMENT, "metric_name").agg(
        F.kll_sketch_agg_double("value", KLL_K).alias("sketch"),
        F.sum("value").alias("total"),
        F.count("value").alias("value_count"),
        F.count("*").alias("sample_count"),
    )


def performance_from_days(days: DataFrame, *keys: str) -> DataFrame:
    """``keys, avg_metric_value, p50, p95, p99, sample_count`` of all of ``days``; null percentiles without any value."""
    merged = days.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", KLL_K).alias("sketch"),
        F.try_divide(F.sum("total"), F.sum("value_count")).alias("avg_metric_value"),
        F.sum("value_count").alias("_values"),
        F.sum("sample_count").alias("sample_count"),
    )
    ranks = F.array(*[F.lit(q) for q in QUANTILES.values()])
    told = F.when(F.col("_values") > 0, F.kll_sketch_get_quantile_double("sketch", ranks)).alias("_q")
    told = merged.select(*keys, "avg_metric_value", told, "sample_count")
    return told.select(*keys, "avg_metric_value", *[F.col("_q")[i].alias(name) for i, name in enumerate(QUANTILES)], "sample_count")


def active_days(events: DataFrame) -> DataFrame:
    """``date, region``, segment, ``devices`` (a sketch) and ``events``: one row per day and segment, whatever the devices."""
    return events.groupBy(event_date().alias("date"), "region", *SEGMENT).agg(
        F.hll_sketch_agg("device_id", LG_K).alias("devices"), F.count("*").alias("events")
    )


def active_devices_range(days: DataFrame, start: str | None = None, end: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``by, active_devices, events`` of a date range (both ends included, either may be open), from :func:`active_days`. Distinct
    devices do not add up over days or segments; sketches do."""
    if start:
        days = days.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        days = days.where(F.col("date") <= F.lit(end).cast("date"))
    merged = days.groupBy(*by).agg(F.hll_union_agg("devices").alias("_devices"), F.sum("events").alias("events"))
    return merged.select(*by, F.coalesce(F.hll_sketch_estimate("_devices"), F.lit(0)).alias("active_devices"), "events")
