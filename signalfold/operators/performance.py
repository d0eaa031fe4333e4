"""Distribution of performance metrics by segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.functions.expressions import is_type, number
from signalfold.schema import SEGMENT


def device_performance_report(events: DataFrame, ordered: bool = True) -> DataFrame:
    """``device_type, os, app_version, avg_metric_value, p50, p95, p99, sample_count`` over all
    metrics together."""
    return _report(events, *SEGMENT, ordered=ordered)


def performance_by_metric(events: DataFrame, ordered: bool = True) -> DataFrame:
    """:func:`device_performance_report` for each ``metric_name``."""
    return _report(events, *SEGMENT, "metric_name", ordered=ordered)


def _report(events: DataFrame, *keys: str, ordered: bool) -> DataFrame:
    """The three percentiles share one sketch of bounded size, merged from the tasks' sketches."""
    samples = events.where(is_type("performance_metric")).select(
        *SEGMENT, F.col("payload.metric_name").alias("metric_name"), number("payload.value").alias("value")
    )
    report = (
        samples.groupBy(*keys)
        .agg(
            F.avg("value").alias("avg_metric_value"),
            F.percentile_approx("value", [0.5, 0.95, 0.99]).alias("_p"),
            F.count("*").alias("sample_count"),
        )
        .select(
            *keys,
            "avg_metric_value",
            F.col("_p")[0].alias("p50"),
            F.col("_p")[1].alias("p95"),
            F.col("_p")[2].alias("p99"),
            "sample_count",
        )
    )
    return report.orderBy(*keys) if ordered else report
