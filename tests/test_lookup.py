"""Lookups read few row groups; reports over tables by device shuffle no devices."""

import re
import uuid
from datetime import date

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from signalfold.operators import crashes, retention
from signalfold.plans import device_tables
from signalfold.plans.batch import extend_roll_ups
from signalfold.session import workspace
from signalfold.settings import LakeSettings, LookupSettings
from signalfold.sinks.batch import compact_days, land_raw
from signalfold.sources.lookup import MOST, any_of, find_events, not_landed
from signalfold.sources.star import telemetry

SMALL = LookupSettings(row_group_bytes=16 << 10, filter_bytes=64 << 10)


def rows_read(df) -> int:
    """Rows that the scans of ``df`` give out, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def events(spark):
    # ids without an order, as producers give them; all on one day, so that no folder is left out
    df = telemetry(spark, SF_DIR, region=False)
    return df.withColumns({"event_id": F.sha2("event_id", 256), "timestamp": F.lit("2024-01-05T01:00:00").cast("timestamp_ntz")})


@pytest.fixture(scope="module")
def landed(spark, events):
    path = workspace(spark, "lookup")
    land_raw(events, path, lookup=SMALL)
    return path


def test_event_ids_read_a_small_part(spark, events, landed):
    ids = [r[0] for r in events.select("event_id").orderBy("event_id").limit(5).collect()]
    found = find_events(spark, landed, ids)
    assert sorted(r["event_id"] for r in found.collect()) == ids
    assert rows_read(find_events(spark, landed, ids)) < 0.35 * events.count()


def test_unknown_ids_read_next_to_nothing(spark, events, landed):
    ids = [F"{i:064x}" for i in range(100)]
    assert find_events(spark, landed, ids).count() == 0
    assert rows_read(find_events(spark, landed, ids)) < 0.05 * events.count()
    plain = workspace(spark, "plain")
    land_raw(events, plain)
    # hashes spread over the whole range: without the filters, smallest and largest value leave nothing out
    ids = [uuid.uuid5(uuid.NAMESPACE_OID, str(i)).hex * 2 for i in range(20)]
    assert rows_read(find_events(spark, plain, ids)) > 0.9 * events.count()
    assert rows_read(find_events(spark, landed, ids)) < 0.05 * events.count()


def test_devices_read_a_small_part(spark, events, landed):
    device = events.groupBy("device_id").count().orderBy("count", "device_id").first()
    found = find_events(spark, landed, device_ids=[device["device_id"]])
    assert found.count() == device["count"]
    assert rows_read(find_events(spark, landed, device_ids=[device["device_id"]])) < 0.35 * events.count()


def test_compacting_keeps_the_layout(spark, events):
    path = workspace(spark, "lookup")
    land_raw(events, path)
    compact_days(spark, path, [date(2024, 1, 5)], lookup=SMALL)
    ids = [f"{i:064x}" for i in range(100)]
    assert rows_read(find_events(spark, path, ids)) < 0.05 * events.count()
    assert spark.read.parquet(path).count() == events.count()


def test_not_landed(spark, events, landed):
    known = events.select("event_id").first()[0]
    assert [r[0] for r in not_landed(spark, landed, [known, "x", "x"]).collect()] == ["x"]


def test_no_ids_and_too_many(spark, landed):
    assert find_events(spark, landed).count() == 0
    with pytest.raises(ValueError, match="too many"):
        any_of("event_id", [str(i) for i in range(MOST + 1)])


# --- tables by device ----------------------------------------------------------


@pytest.fixture(scope="module")
def lake(spark):
    lake = LakeSettings(root=workspace(spark, "lake"), database=f"t_{uuid.uuid4().hex}", device_buckets=4)
    extend_roll_ups(telemetry(spark, SF_DIR), lake, device_tables.DEVICE_TABLES)
    device_tables.extend_device_tables(spark, lake)
    return lake


def exchanged(df) -> list[str]:
    """What the shuffles of a plan go by."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_no_shuffle_of_devices(spark, lake):
    days = device_tables.device_table(spark, "device_days", lake)
    plans = [retention.cohorts_from_activity(days), crashes.crashes_from_activity(days), device_tables.features_of_crashed(spark, lake)]
    first = days.groupBy("device_id").agg(F.min("date").alias("first"))
    plans.append(days.join(first.hint("merge"), "device_id").groupBy("first").count())
    for df in plans:
        by = exchanged(df)
        assert len(by) == 1 and "device_id" not in by[0]


def test_other_days_stay_and_a_second_run_changes_nothing(spark, lake):
    days = device_tables.device_table(spark, "device_days", lake)
    before = sorted(map(repr, days.collect()))
    files = {f for f in days.inputFiles() if "date=2024-01-10" not in f}
    device_tables.extend_device_tables(spark, lake, [date(2024, 1, 10)])
    days = device_tables.device_table(spark, "device_days", lake)
    assert sorted(map(repr, days.collect())) == before
    assert {f for f in days.inputFiles() if "date=2024-01-10" not in f} == files


def test_one_file_per_bucket_and_day(spark, lake):
    folders = [f.rsplit("/", 1)[0] for f in device_tables.device_table(spark, "device_days", lake).inputFiles()]
    assert max(folders.count(f) for f in set(folders)) <= lake.device_buckets


def test_another_catalog_finds_stored_tables(spark, lake):
    other = LakeSettings(root=lake.root, database=f"t_{uuid.uuid4().hex}", device_buckets=4)
    device_tables.register_device_tables(spark, other)
    assert device_tables.device_table(spark, "device_days", other).count() == device_tables.device_table(spark, "device_days", lake).count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_statistics(spark, lake):
    device_tables.analyze_device_tables(spark, lake)
    stats = spark.sql(f"DESCRIBE EXTENDED {device_tables.table_name('device_days', lake)} device_id").collect()
    assert int({r[0]: r[1] for r in stats}["distinct_count"]) > 0
