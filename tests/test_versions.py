"""Published versions: readers see a whole report whatever step a run dies at, and the next run completes."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from signalfold.plans import catalog
from signalfold.settings import LakeSettings
from signalfold.sinks import batch as sinks
from signalfold.sinks import versions


class Died(Exception):
    pass


@pytest.fixture
def dying(monkeypatch):
    """Make the run die before, or half-way into, its n-th write, marking or removal."""

    def at(step):
        left = [step]

        def counted(real, half=None):
            def run(*args, **kwargs):
                left[0] -= 1
                if left[0] == 0:
                    if half:
                        half(*args)
                    raise Died
                return real(*args, **kwargs)

            return run

        def half_written(writer, path):
            os.makedirs(path)
            open(f"{path}/part-00000.parquet", "w").close()

        monkeypatch.setattr(DataFrameWriter, "parquet", counted(DataFrameWriter.parquet, half_written))
        for name in ("_mark", "remove"):
            monkeypatch.setattr(versions, name, counted(getattr(versions, name)))
        monkeypatch.setattr(sinks, "remove", versions.remove)

    yield at
    monkeypatch.undo()


def days(spark, *numbers):
    return spark.createDataFrame([(date(2024, 1, d), "A", d, 1) for d in numbers], "date date, region string, daily_active_users long, total_events long")


def told(df):
    return sorted(r.date.day for r in df.collect())


def test_versions_are_kept_and_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    held = None
    for n in range(1, 7):
        place = versions.publish(spark.range(n), path)
        assert versions.read_current(spark, path).count() == n and place == versions.current(spark, path)
        held = held or versions.read_current(spark, path)
        if n == versions.KEPT:
            assert held.count() == 1  # a reader that began with the first
    assert versions.published(spark, path) == [4, 5, 6]
    # a new version may be made of the old one
    versions.publish(versions.read_current(spark, path).union(spark.range(1)), path)
    assert versions.read_current(spark, path).count() == 7
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        versions.read_current(spark, str(tmp_path / "nowhere"))


@pytest.mark.parametrize("step", range(1, 5))
def test_report_stays_readable_when_its_run_dies(spark, tmp_path, dying, step, monkeypatch):
    path = str(tmp_path)
    for n in (1, 2, 3):
        sinks.write_reports({"regional_trends": days(spark, *range(1, n + 1))}, path)
    dying(step)
    new = {"regional_trends": days(spark, 7, 8)}
    try:
        sinks.write_reports(new, path)
        died = False
    except Died:
        died = True
    monkeypatch.undo()
    assert died == (step <= 3)
    assert told(versions.read_current(spark, f"{path}/regional_trends")) == ([1, 2, 3] if step <= 2 else [7, 8])
    sinks.write_reports(new, path)
    assert told(versions.read_current(spark, f"{path}/regional_trends")) == [7, 8]
    left = os.listdir(f"{path}/regional_trends")
    assert len(left) == versions.KEPT and all(versions.MARKER in os.listdir(f"{path}/regional_trends/{n}") for n in left)


def archived(spark, lake):
    tiers = {}
    for r in sinks.read_archive(spark, "regional_trends", lake).collect():
        tiers.setdefault(r.archived_before.day, []).append((r.date.day, r.daily_active_users))
    return {k: sorted(v) for k, v in tiers.items()}


def test_archive_run_that_dies_anywhere_loses_nothing_and_can_be_repeated(spark, tmp_path, dying, monkeypatch):
    """The second run archives new days, a late one and a corrected one. It dies at each step in turn."""
    ended = False
    for step in range(1, 30):
        lake = LakeSettings(root=str(tmp_path / str(step)), archive_after_days=10)
        sinks.write_reports({"regional_trends": days(spark, 1, 2, 6, 9)}, lake.batch)
        sinks.archive_report(spark, "regional_trends", date(2024, 1, 15), lake)
        corrected = days(spark, 2, 3, 6, 9).withColumn("daily_active_users", F.when(F.dayofmonth("date") == 2, 77).otherwise(F.col("daily_active_users")))
        sinks.write_reports({"regional_trends": corrected}, lake.batch)
        dying(step)
        try:
            sinks.archive_report(spark, "regional_trends", date(2024, 1, 18), lake)
            ended = True
        except Died:
            pass
        monkeypatch.undo()
        served = versions.read_current(spark, f"{lake.batch}/regional_trends")
        known = {d for rows in archived(spark, lake).values() for d, _ in rows} | set(told(served))
        assert known == {1, 2, 3, 6, 9}, step
        sinks.archive_report(spark, "regional_trends", date(2024, 1, 18), lake)
        assert archived(spark, lake) == {5: [(1, 1)], 8: [(2, 77), (3, 3), (6, 6)]}, step
        assert told(versions.read_current(spark, f"{lake.batch}/regional_trends")) == [9], step
        if ended:
            break
    assert ended and step > 7


def test_table_is_switched_to_the_published_version(spark, make_events, tmp_path):
    lake = LakeSettings(root=str(tmp_path), database="versions_test")
    trends = spark.createDataFrame([(date(2024, 1, 1), 1, 2, 3)], "date date, daily_active_users long, total_events long, total_sessions long")
    sinks.land_raw(make_events({}), lake.raw)
    sinks.write_reports({"daily_trends": trends}, lake.batch)
    catalog.register_lake(spark, lake)
    table = spark.table("versions_test.daily_trends")
    assert table.count() == 1 and spark.table("versions_test.crash_analysis").count() == 0
    sinks.write_reports({"daily_trends": trends.union(trends)}, lake.batch)
    assert table.count() == 1  # as it was registered, until it is switched
    catalog.register_lake(spark, lake)
    assert spark.table("versions_test.daily_trends").count() == 2
