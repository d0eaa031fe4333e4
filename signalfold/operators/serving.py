"""The serving queries: filter, sort and limit over the stored reports.

Missing data raises; there is no stand-in for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalfold.functions.expressions import event_date, is_type, ratio
from signalfold.operators.crashes import crash_analysis, top_crash_segments
from signalfold.operators.usage import daily_usage_trends, hourly_usage_trends
from signalfold.schema import SEGMENT
from signalfold.sinks.versions import read_current

TOP_FEATURES = 10


def _equal(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows equal to every given value; an empty value filters nothing."""
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


def _between(df: DataFrame, column, start: str | None, end: str | None) -> DataFrame:
    """Rows of the inclusive date range; either end may be open."""
    if start:
        df = df.where(column >= F.lit(start).cast("date"))
    if end:
        df = df.where(column <= F.lit(end).cast("date"))
    return df


def _in_days(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Events of the date range; landed events are also cut by the folders of their days."""
    events = _between(events, event_date(), start, end)
    return _between(events, F.col("event_date"), start, end) if "event_date" in events.columns else events


def _first(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def usage(
    daily_trends: DataFrame, start_date: str | None = None, end_date: str | None = None, limit: int | None = None
) -> DataFrame:
    """Stored daily trends of a date range, oldest first; all of them, or the first ``limit``."""
    return _first(_between(daily_trends, F.col("date"), start_date, end_date).orderBy("date"), limit)


def usage_from_events(
    events: DataFrame,
    region: str | None = None,
    device_type: str | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    granularity: str = "daily",
    limit: int | None = None,
) -> DataFrame:
    """:func:`usage` for one region or device type, or by hour. Distinct devices do not add up over
    regions, so this reads the events; all filters reach the scan."""
    rows = _in_days(_equal(events, region=region, device_type=device_type), start_date, end_date)
    if granularity == "hourly":
        return _first(hourly_usage_trends(rows, ordered=False).orderBy("hour"), limit)
    if granularity == "daily":
        return _first(daily_usage_trends(rows, ordered=False).orderBy("date"), limit)
    raise ValueError(f"granularity must be daily or hourly, not {granularity!r}")


def crashes(
    analysis: DataFrame,
    os: str | None = None,
    app_version: str | None = None,
    device_type: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Stored crash segments, most crashes first; all of them, or the first ``limit``."""
    return top_crash_segments(_equal(analysis, os=os, app_version=app_version, device_type=device_type), limit)


def adoption(feature_ranking: DataFrame, feature: str | None = None, top_n: int = TOP_FEATURES) -> DataFrame:
    """The ``top_n`` best-ranked stored features."""
    return _equal(feature_ranking, feature_name=feature).orderBy("rank").limit(top_n)


def performance(
    device_performance: DataFrame,
    device_type: str | None = None,
    os: str | None = None,
    metric_name: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Stored performance segments in segment order; all of them, or the first ``limit``. ``metric_name``
    needs the report by metric."""
    rows = _equal(device_performance, device_type=device_type, os=os, metric_name=metric_name)
    order = [c for c in (*SEGMENT, "metric_name") if c in rows.columns]
    return _first(rows.orderBy(*order), limit)


def realtime_snapshot(events: DataFrame) -> DataFrame:
    """One row: ``snapshot_time, active_users_1m, events_per_second, error_rate`` of the minute that
    ends with the newest event. The minute's start is a scalar subquery over one column, plain
    enough to be pushed to the scan of the second read. Of landed events, only the folders of the newest day and
    the one before are read."""
    if "event_date" in events.columns:
        newest = events.agg(F.max("event_date").alias("newest")).scalar()
        events = events.where(F.col("event_date") >= F.date_sub(newest, 1))
    start = events.agg((F.max("timestamp") - F.expr("INTERVAL 1 MINUTE")).alias("start")).scalar()
    last_minute = events.where(F.col("timestamp") > start)
    return last_minute.agg(
        F.max("timestamp").alias("snapshot_time"),
        F.countDistinct("device_id").alias("active_users_1m"),
        (F.count("*") / F.lit(60.0)).alias("events_per_second"),
        ratio(F.count_if(is_type("crash_event")), F.count("*")).alias("error_rate"),
    )


def snapshot_from_windows(active_users: DataFrame, error_spikes: DataFrame, now: str | None = None) -> DataFrame:
    """:func:`realtime_snapshot` from the stored windows of the speed layer: the newest minute that it has closed.

    Devices count once per region and device type, as the windows do. ``snapshot_time`` is the minute's end. Only the
    newest day's folder is read, which the partition column names; ``now`` (a date) spares even looking for it.
    """
    newest = F.lit(now).cast("date") if now else active_users.agg(F.max("window_date").alias("newest")).scalar()
    today = active_users.where(F.col("window_date") == newest)
    minute = today.agg(F.max("window_start").alias("minute")).scalar()
    users = today.where(F.col("window_start") == minute).agg(
        F.max("window_end").alias("snapshot_time"),
        F.sum("active_users").alias("active_users_1m"),
        F.sum("event_count").alias("_events"),
    )
    failed = error_spikes.where(
        (F.col("window_date") == newest)
        & (F.col("window_start") >= minute)
        & (F.col("window_start") < minute + F.expr("INTERVAL 1 MINUTE"))
    ).agg(F.coalesce(F.sum("crash_count"), F.lit(0)).alias("crashes")).scalar()
    return users.select(
        "snapshot_time",
        "active_users_1m",
        (F.col("_events") / F.lit(60.0)).alias("events_per_second"),
        ratio(failed, F.col("_events")).alias("error_rate"),
    )


class MetricsStore:
    """The serving queries over the reports stored below ``batch_path``.

    The real-time snapshot comes from the speed layer's windows below ``metrics_path``, or, without one, from
    ``events``.

    Filters that the stored reports cannot answer (a region, a device type or hours for usage, dates
    for crashes) are answered from ``events``, which is then needed.
    """

    def __init__(
        self, spark: SparkSession, batch_path: str, events: DataFrame | None = None, metrics_path: str | None = None
    ):
        self._spark = spark
        self._metrics = metrics_path.rstrip("/") if metrics_path else None
        self._path = batch_path.rstrip("/")
        self._raw = events

    def _read(self, name: str) -> DataFrame:
        return read_current(self._spark, f"{self._path}/{name}")

    def _events(self, what: str) -> DataFrame:
        if self._raw is None:
            raise ValueError(f"{what} cannot be answered from the stored reports; pass events")
        return self._raw

    def get_usage_metrics(
        self,
        region: str | None = None,
        device_type: str | None = None,
        start_date: str | None = None,
        end_date: str | None = None,
        granularity: str = "daily",
        limit: int | None = None,
    ) -> DataFrame:
        if region or device_type or granularity != "daily":
            events = self._events("usage by region, device type or hour")
            return usage_from_events(events, region, device_type, start_date, end_date, granularity, limit)
        return usage(self._read("daily_trends"), start_date, end_date, limit)

    def get_crash_metrics(
        self,
        os: str | None = None,
        app_version: str | None = None,
        device_type: str | None = None,
        start_date: str | None = None,
        end_date: str | None = None,
        limit: int | None = None,
    ) -> DataFrame:
        if start_date or end_date:
            rows = _in_days(self._events("crashes of a date range"), start_date, end_date)
            return crashes(crash_analysis(rows, ordered=False), os, app_version, device_type, limit)
        return crashes(self._read("crash_analysis"), os, app_version, device_type, limit)

    def get_adoption_metrics(self, feature: str | None = None, top_n: int = TOP_FEATURES) -> DataFrame:
        return adoption(self._read("feature_ranking"), feature, top_n)

    def get_performance_metrics(
        self, device_type: str | None = None, os: str | None = None, metric_name: str | None = None, limit: int | None = None
    ) -> DataFrame:
        name = "performance_by_metric" if metric_name else "device_performance"
        return performance(self._read(name), device_type, os, metric_name, limit)

    def get_realtime_snapshot(self) -> DataFrame:
        if self._metrics:
            windows = [self._spark.read.parquet(f"{self._metrics}/{name}") for name in ("active_users", "error_spikes")]
            return snapshot_from_windows(*windows)
        return realtime_snapshot(self._events("the real-time snapshot"))
