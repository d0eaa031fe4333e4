"""Roll-ups that a day is added to: sketches, bitmaps, and what adding reads and writes."""

import os
from datetime import date, timedelta
from pathlib import Path

import numpy as np
import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from signalfold.operators import device_bitmaps, retention, sketches
from signalfold.plans.batch import extend_bitmaps, extend_roll_ups, reports, run_batch
from signalfold.settings import LakeSettings, Settings
from signalfold.sinks.versions import read_current
from signalfold.sources.star import telemetry


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_ranks_of_merged_quantile_sketches(spark):
    """30 days of 20,000 samples: the ranks of the percentiles are within the stated error."""
    value = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1000
    samples = spark.range(600_000).select(
        F.lit("performance_metric").alias("event_type"), F.expr("date_add(date '2024-01-01', CAST(id % 30 AS int))").cast("timestamp").alias("timestamp"),
        F.lit("mobile").alias("device_type"), F.lit("iOS").alias("os"), F.lit("1").alias("app_version"),
        F.struct(F.lit("m").alias("metric_name"), value.alias("value")).alias("payload"),
    )
    days = sketches.performance_days(samples)
    assert days.count() == 30 and days.agg(F.max(F.length("sketch"))).first()[0] < 150_000
    got = sketches.performance_from_days(days, "metric_name").first()
    values = np.sort([r.v for r in samples.select(F.col("payload.value").alias("v")).collect()])
    for name, q in sketches.QUANTILES.items():
        assert abs(np.searchsorted(values, got[name]) / len(values) - q) <= sketches.RANK_ERROR
    assert got.sample_count == 600_000 and got.avg_metric_value == pytest.approx(values.mean())


def test_samples_without_a_number(spark, make_events):
    sample = dict(event_type="performance_metric", metric_name="m")
    days = sketches.performance_days(make_events(sample, sample, dict(sample, metric_name="n", value=3.0), dict(sample, metric_name="n")))
    got = {r.metric_name: (r.avg_metric_value, r.p50, r.p99, r.sample_count) for r in sketches.performance_from_days(days, "metric_name").collect()}
    assert got == {"m": (None, None, None, 2), "n": (3.0, 3.0, 3.0, 2)}


def test_distinct_sketches_of_a_range(spark):
    """100,000 devices a day, half of them new each day: three standard errors hold for any range."""
    events = spark.range(600_000).select(
        F.expr("date_add(date '2024-01-01', CAST(id DIV 100000 AS int))").cast("timestamp").alias("timestamp"),
        ((F.col("id") % 100_000) + F.expr("id DIV 100000") * 50_000).cast("string").alias("device_id"),
        *[F.lit("x").alias(c) for c in ("region", "device_type", "os", "app_version")],
    )
    days = sketches.active_days(events)
    assert days.count() == 6
    for first, last in ((0, 0), (1, 3), (0, 5)):
        start, end = (str(date(2024, 1, 1) + timedelta(days=d)) for d in (first, last))
        exact = 100_000 + (last - first) * 50_000
        got = sketches.active_devices_range(days, start, end).first()
        assert abs(got.active_devices - exact) <= 3 * sketches.DEVICE_ERROR * exact and got.events == (last - first + 1) * 100_000


def test_range_without_devices(spark, make_events):
    days = sketches.active_days(make_events(dict(device_id=None), dict(device_id=None)))
    assert rows(sketches.active_devices_range(days)) == [(0, 2)]
    assert rows(sketches.active_devices_range(days, "2030-01-01", by=["region"])) == []


@pytest.fixture
def long_lived(make_events):
    """Devices over 200 days, across words of 64 days and before 1970, with days and devices unknown."""
    rng = np.random.default_rng(1)
    stamps = [(f"d{d}", date(2023, 10, 1) + timedelta(days=int(x))) for d in range(40) for x in rng.choice(200, rng.integers(1, 30))]
    stamps += [("old", date(1969, 12, 20)), ("old", date(1970, 1, 3)), ("old", date(2024, 3, 5))]
    made = [dict(device_id=d, timestamp=f"{day}T05:00:00") for d, day in stamps]
    return make_events(*made, dict(device_id=None), dict(timestamp=None))


@pytest.mark.parametrize("cohort_days", [1, 7, 30, 100])
def test_bitmaps_give_the_cohorts(long_lived, cohort_days):
    words = device_bitmaps.bitmaps(long_lived.select("device_id", F.to_date("timestamp").alias("date")))
    got = device_bitmaps.retention_from_bitmaps(words, cohort_days)
    expected = retention.retention_rates(long_lived, cohort_days)
    assert sorted(map(str, rows(got.select(expected.columns)))) == sorted(map(str, rows(expected)))
    first = device_bitmaps.first_days(words)
    known = retention.device_first_seen(long_lived.where("device_id is not null and timestamp is not null"))
    assert sorted(rows(first)) == sorted(rows(known))


def test_lifecycle_counts_each_device_once(long_lived):
    words = device_bitmaps.bitmaps(long_lived.select("device_id", F.to_date("timestamp").alias("date")))
    days = {}
    for r in long_lived.where("device_id is not null and timestamp is not null").collect():
        days.setdefault(r.device_id, set()).add(r.timestamp.date())
    for as_of in (date(2024, 1, 5), date(2024, 2, 9), date(2024, 12, 1)):
        expected = dict.fromkeys(("new", "retained", "returning", "lost", "gone"), 0)
        for seen in days.values():
            ago = {(as_of - d).days for d in seen if d <= as_of}
            now, before, earlier = any(a < 7 for a in ago), any(7 <= a < 14 for a in ago), any(14 <= a <= (as_of - date(1970, 1, 1)).days for a in ago)
            if not (now or before or earlier):
                continue
            expected["retained" if now and before else "returning" if now and earlier else "new" if now else "lost" if before else "gone"] += 1
        assert dict(rows(device_bitmaps.lifecycle(words, as_of))) == expected


def test_bitmaps_are_extended_and_corrected_by_day(spark, tmp_path, make_events):
    lake = LakeSettings(root=str(tmp_path))
    day = lambda d, *devices: make_events(*[dict(device_id=x, timestamp=f"{d}T01:00:00") for x in devices]).select("device_id", F.to_date("timestamp").alias("date"))
    extend_bitmaps(day("2023-06-01", "a", "b"), lake)
    extend_bitmaps(day("2024-01-01", "a", "b").union(day("2024-01-02", "a", "c")), lake)
    before = files(tmp_path)
    words = extend_bitmaps(day("2024-01-02", "c"), lake)  # a correction: a was not there
    after = files(tmp_path)
    assert {p for p in before if p in after and before[p] == after[p]} == {p for p in before if "period=304" in p or "period=305" in p} and len(after) >= 2
    found = {(r.device_id, r.first_seen) for r in device_bitmaps.first_days(words).collect()}
    assert found == {("a", date(2023, 6, 1)), ("b", date(2023, 6, 1)), ("c", date(2024, 1, 2))}
    assert sum(bin(r.days & (2**64 - 1)).count("1") for r in words.collect()) == 5
    once = sorted(rows(words))
    assert sorted(rows(extend_bitmaps(day("2024-01-02", "c"), lake))) == once


def test_adding_a_day_touches_no_other_and_reads_no_history(spark, tmp_path):
    events = telemetry(spark, SF_DIR)
    lake = LakeSettings(root=str(tmp_path))
    old, new = events.where(F.col("timestamp") < F.lit("2024-01-20").cast("timestamp_ntz")), events.where(F.to_date("timestamp") == F.lit("2024-01-20").cast("date"))
    extend_roll_ups(old, lake)
    before = files(tmp_path)
    rolled = extend_roll_ups(new, lake)
    after = files(tmp_path)
    assert before.items() <= after.items()
    assert {os.path.basename(os.path.dirname(p)) for p in after.keys() - before.keys()} == {"date=2024-01-20"}
    # the reports over the roll-ups read no event
    for name, report in reports(events.where("1 = 0"), rolled=rolled).items():
        text = report._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in text, name


def test_two_steps_equal_one(spark, tmp_path):
    events = telemetry(spark, SF_DIR)
    one, two = (LakeSettings(root=str(tmp_path / n)) for n in ("one", "two"))
    run_batch(events, Settings(lake=one))
    cut = F.col("timestamp") < F.lit("2024-01-11").cast("timestamp_ntz")
    extend_roll_ups(events.where(cut), two)
    extend_bitmaps(events.where(cut).select("device_id", F.to_date("timestamp").alias("date")), two)
    run_batch(events, Settings(lake=two), new_days=events.where(~cut))
    for name in reports(events):
        both = [read_current(spark, f"{lake.batch}/{name}") for lake in (one, two)]
        both = [df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"}) for df in both]
        assert sorted(map(str, rows(both[0]))) == sorted(map(str, rows(both[1].select(both[0].columns)))), name
    maps = [spark.read.parquet(f"{lake.rollups}/device_bitmaps") for lake in (one, two)]
    assert sorted(rows(maps[0])) == sorted(rows(maps[1].select(maps[0].columns)))
