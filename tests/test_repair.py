"""Late rows in a second landing: exactly their windows change."""

import time
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalfold.operators.windows import active_users_per_minute, error_spikes, feature_usage
from signalfold.plans import repair
from signalfold.settings import LakeSettings, Settings
from signalfold.sinks import batch as sinks
from signalfold.sinks import versions

OPERATORS = {"active_users": active_users_per_minute, "error_spikes": error_spikes, "feature_usage": feature_usage}


@pytest.fixture
def lake(spark, make_events, tmp_path):
    """Five minutes of two events each, landed, and their windows as the stream has stored them."""
    stamp = lambda df: df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    on_time = stamp(make_events(*[dict(timestamp=f"2024-01-01T23:5{m}:10", device_id=d, event_type=t) for m in range(5, 10) for d, t in (("a", "feature_used"), ("b", "crash_event"))]))
    settings = replace(Settings(), lake=LakeSettings(root=str(tmp_path)))
    sinks.land_raw(on_time, settings.lake.raw)
    for name, operator in OPERATORS.items():
        closed = operator(on_time).where("window_end <= timestamp '2024-01-01 23:59:00'")
        closed.withColumn("window_date", F.to_date("window_start")).write.partitionBy("window_date").parquet(f"{settings.lake.metrics}/{name}")
    assert repair.repair_windows(spark, settings) is not None  # what the stream has seen
    return settings, lambda *late: time.sleep(0.02) or sinks.land_raw(stamp(make_events(*late)), settings.lake.raw)


def told(df):
    return sorted(map(str, rows(df.select(sorted(df.columns)))))


def windows(spark, settings, name="active_users"):
    return {str(r.window_start)[11:16]: (r.active_users, r.event_count) for r in repair.repaired_windows(spark, name, settings.lake).collect()}


def test_only_the_windows_of_late_rows_change(spark, lake):
    settings, land = lake
    assert windows(spark, settings) == {m: (2, 2) for m in ("23:55", "23:56", "23:57", "23:58")}
    before = versions.current(spark, f"{settings.lake.repaired}/active_users")
    land(dict(timestamp="2024-01-01T23:56:50", device_id="late"), dict(timestamp="2024-01-01T23:54:01", device_id="a"), dict(timestamp="2024-01-02T00:00:01"))
    fresh = repair.landed_since(spark, settings.lake, repair.last_mark(spark, settings.lake))
    assert fresh.count() == 3
    assert repair.repair_windows(spark, settings) is not None
    # the window of the last row isn't closed yet
    assert windows(spark, settings) == {"23:54": (1, 1), "23:55": (2, 2), "23:56": (3, 3), "23:57": (2, 2), "23:58": (2, 2)}
    everything = spark.read.parquet(settings.lake.raw)
    for name, operator in OPERATORS.items():
        expected = operator(everything).where("window_end <= timestamp '2024-01-01 23:59:00'")
        assert told(repair.repaired_windows(spark, name, settings.lake).drop("window_date")) == told(expected), name
    assert versions.current(spark, f"{settings.lake.repaired}/active_users") != before
    assert repair.repair_windows(spark, settings) is None  # nothing new


def test_repair_that_dies_is_repeated(spark, lake, monkeypatch):
    settings, land = lake
    land(dict(timestamp="2024-01-01T23:55:50", device_id="late"))
    real, left = repair.publish, [2]

    def dying(df, path):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("died")
        return real(df, path)

    monkeypatch.setattr(repair, "publish", dying)
    with pytest.raises(RuntimeError):
        repair.repair_windows(spark, settings)
    monkeypatch.setattr(repair, "publish", real)
    assert repair.repair_windows(spark, settings) is not None
    assert windows(spark, settings)["23:55"] == (3, 3)
    everything = spark.read.parquet(settings.lake.raw)
    spikes = repair.repaired_windows(spark, "feature_usage", settings.lake).drop("window_date")
    assert told(spikes) == told(feature_usage(everything).where("window_end <= timestamp '2024-01-01 23:59:00'"))


def test_older_files_are_not_opened(spark, lake):
    settings, land = lake
    mark = repair.last_mark(spark, settings.lake)
    land(dict(timestamp="2024-01-01T23:55:50"))
    fresh = repair.landed_since(spark, settings.lake, mark)
    assert fresh.count() == 1
    assert len({r.f for r in fresh.select(F.input_file_name().alias("f")).collect()}) == 1
    metrics = fresh._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    fresh._jdf.queryExecution().toRdd().count()
    assert metrics.apply("numFiles").value() == 1
