"""Repair of the speed layer's windows after late data.

A stream drops the rows that come after the watermark; the landing has them. A repair reads the files that were landed since the
last one, by file metadata, recomputes the closed windows that their rows fall in from all landed rows, and puts these in
the place of the stored ones. No other window is read or changed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalfold.operators.windows import active_users_per_minute, error_spikes, feature_usage
from signalfold.settings import LakeSettings, Settings, StreamSettings
from signalfold.sinks.versions import current, publish, read_current

FILE_TIME = "_metadata.file_modification_time"
_WINDOW = ("window_start", "window_end")


def _operators(settings: StreamSettings) -> dict:
    return {
        "active_users": (active_users_per_minute, settings.usage_window),
        "error_spikes": (error_spikes, settings.error_window),
        "feature_usage": (feature_usage, settings.usage_window),
    }


def landed_since(spark: SparkSession, lake: LakeSettings, mark: datetime | None, checked: bool = False) -> DataFrame:
    """Landed events of the files written after ``mark`` (none: all), with ``file_time``. The condition is on file metadata, so
    older files are not opened."""
    rows = _landed(spark, lake, checked).select("*", F.col(FILE_TIME).alias("file_time"))
    return rows if mark is None else rows.where(F.col(FILE_TIME) > F.lit(mark))


def _landed(spark: SparkSession, lake: LakeSettings, checked: bool) -> DataFrame:
    rows = spark.read.parquet(lake.raw)
    return rows.where("status = 'valid'") if checked else rows


def last_mark(spark: SparkSession, lake: LakeSettings) -> datetime | None:
    """The time of the newest file that the last finished repair has seen."""
    path = f"{lake.repaired}/marks"
    return read_current(spark, path).first()["file_time"] if current(spark, path) else None


def set_mark(spark: SparkSession, lake: LakeSettings, mark: datetime) -> None:
    publish(spark.createDataFrame([(mark,)], "file_time timestamp"), f"{lake.repaired}/marks")


def repair_windows(spark: SparkSession, settings: Settings = Settings(), checked: bool = False) -> datetime | None:
    """Repair the stored windows of the three aggregates; the new mark, or None if nothing was landed since the last.

    Windows that the stream has not closed yet are left to it. The recomputed ones are published as a table beside the
    stream's files, whose commit log names what counts there; :func:`repaired_windows` reads both. The aggregates are repaired
    at the same time, as none of them fills a cluster. The mark is set last: a run that dies is run again, with the same result.
    """
    lake = settings.lake
    fresh = landed_since(spark, lake, last_mark(spark, lake), checked)
    newest = fresh.agg(F.max("file_time").alias("t")).first()["t"]
    if newest is None:
        return None

    def repaired(name: str) -> None:
        operator, width = operators[name]
        stored = spark.read.parquet(f"{lake.metrics}/{name}")
        closed = stored.agg(F.max("window_end").alias("t")).first()["t"]
        span = F.window("timestamp", width)
        # windows of the new rows, and the day folders these rows lie in
        touched = fresh.where(F.col("file_time") <= F.lit(newest)).select(span.alias("w")).distinct().select("w.start", "w.end")
        touched = touched.where(F.col("end") <= F.lit(closed))
        days = touched.select(F.explode(F.array(F.to_date("start"), F.to_date("end"))).alias("event_date")).distinct()
        near = _landed(spark, lake, checked).join(days, "event_date", "left_semi")
        again = near.select("*", span.alias("w")).join(touched, F.col("w.start") == F.col("start"), "left_semi").drop("w")
        windows = operator(again, width).withColumn("window_date", F.to_date("window_start"))
        path = f"{lake.repaired}/{name}"
        if current(spark, path):
            windows = windows.unionByName(_without(read_current(spark, path), windows))
        publish(windows, path)

    operators = _operators(settings.stream)
    with ThreadPoolExecutor(max_workers=len(operators)) as pool:
        list(pool.map(inheritable_thread_target(spark)(repaired), operators))
    set_mark(spark, lake, newest)
    return newest


def _without(windows: DataFrame, replaced: DataFrame) -> DataFrame:
    starts = replaced.select(F.col("window_start").alias("_start")).distinct()
    return windows.join(starts, F.col("window_start") == F.col("_start"), "left_anti")


def repaired_windows(spark: SparkSession, name: str, lake: LakeSettings = LakeSettings()) -> DataFrame:
    """The windows of an aggregate: those that were repaired, and of the stream's the others."""
    stored, path = spark.read.parquet(f"{lake.metrics}/{name}"), f"{lake.repaired}/{name}"
    if not current(spark, path):
        return stored
    repaired = read_current(spark, path)
    return repaired.unionByName(_without(stored, repaired))
