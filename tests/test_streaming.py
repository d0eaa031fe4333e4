"""Streams against the same operators on a batch; late rows; restarts; sinks."""

import os
import re
import time
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from signalfold.operators import windows
from signalfold.schema import event_schema
from signalfold.sources.star import telemetry
from signalfold.sources.wire import read_file_stream, with_event_time
from signalfold.streaming import jobs

SENTINEL = "2030-01-01T00:00:00"
OPERATORS = {
    "active_users": windows.active_users_per_minute,
    "error_spikes": windows.error_spikes,
    "feature_usage": windows.feature_usage,
    "spike_alerts": windows.spike_alerts,
}


@pytest.fixture(scope="module")
def session(spark):
    return jobs.streaming_session(spark, shuffle_partitions=2)


def drop(df, folder, name, age):
    """One more file for the stream; smaller age = newer, and newer files come later."""
    target = f"{folder}/{name}.parquet"
    pq.write_table(df.toArrow(), target)
    stamp = time.time() - age
    os.utime(target, (stamp, stamp))


@pytest.fixture(scope="module")
def day(spark):
    """Two hours of the test events, with a timestamp that has a zone."""
    events = telemetry(spark, SF_DIR).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return events.where("timestamp >= '2024-01-02 10:00:00' and timestamp < '2024-01-02 13:00:00'").cache()


@pytest.fixture(scope="module")
def folder(spark, day, tmp_path_factory):
    """Three files in event order, cut inside minutes, then a far-future row and a late one."""
    path = str(tmp_path_factory.mktemp("stream"))
    cuts = ["2024-01-02 10:00:00", "2024-01-02 10:50:30", "2024-01-02 11:45:15", "2024-01-02 13:00:00"]
    for i, (start, end) in enumerate(zip(cuts, cuts[1:])):
        drop(day.where(f"timestamp >= '{start}' and timestamp < '{end}'").orderBy("timestamp"), path, f"f{i}", 1000 - i * 100)
    one = day.limit(1)
    drop(one.withColumn("timestamp", F.lit(SENTINEL).cast("timestamp")), path, "sentinel", 300)
    late = one.withColumn("event_type", F.lit("crash_event")).withColumn("event_id", F.lit("late"))
    drop(late, path, "zlate", 100)
    return path


def stream(session, folder):
    events = read_file_stream(session, folder, event_schema(), max_files_per_trigger=1)
    return with_event_time(events, "10 seconds")


@pytest.mark.parametrize("name", list(OPERATORS))
def test_stream_equals_batch(spark, session, day, folder, tmp_path, name):
    operator = OPERATORS[name]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = jobs.write_parquet_stream(operator(stream(session, folder)), name, out, checkpoint, trigger=None)
    jobs.run_to_end(query)
    stored = spark.read.parquet(out)
    assert "window_date" in stored.columns and sorted(os.listdir(out))[-1].startswith("window_date=")
    got = stored.drop("window_date").where(F.col("window_start") < F.lit("2029-01-01"))
    expected = operator(day)
    assert expected.count() > 0
    assert sorted(map(str, rows(got.select(*expected.columns)))) == sorted(map(str, rows(expected)))
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    if name in ("active_users", "spike_alerts", "error_spikes"):
        assert dropped == 1  # the late row


def test_restart_from_checkpoint_repeats_and_loses_nothing(spark, session, day, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    os.mkdir(source)
    ordered = day.orderBy("timestamp")
    middle = "2024-01-02 11:00:30"
    parts = [
        ordered.where(f"timestamp < '{middle}'"), ordered.where(f"timestamp >= '{middle}'"),
        day.limit(1).withColumn("timestamp", F.lit(SENTINEL).cast("timestamp")),
    ]
    for i, part in enumerate(parts):
        drop(part, source, f"p{i}", 1000 - i * 100)
        windows_df = windows.active_users_per_minute(stream(session, source))
        jobs.run_to_end(jobs.write_parquet_stream(windows_df, f"restart{i}", out, checkpoint, trigger=None))
    got = spark.read.parquet(out).drop("window_date").where("window_start < '2029-01-01'")
    expected = windows.active_users_per_minute(day)
    assert sorted(map(str, rows(got.select(*expected.columns)))) == sorted(map(str, rows(expected)))


def test_speed_layer_runs_three_queries(spark, session, folder, tmp_path):
    events = stream(session, folder)
    queries = jobs.start_speed_layer(events, events, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    for query in queries:
        jobs.run_to_end(query)
    assert sorted(os.listdir(tmp_path / "out")) == ["active_users", "error_spikes", "feature_usage"]


def test_failure_of_any_query_is_raised(spark, session, folder, tmp_path):
    session.streams.resetTerminated()
    bad = stream(session, folder).withColumn("os", F.raise_error(F.lit("broken on purpose")).cast("string"))
    query = jobs.land_raw_stream(bad, str(tmp_path / "out"), str(tmp_path / "ck"), trigger="1 second")
    with pytest.raises(Exception, match="broken on purpose"):
        jobs.await_any(session)
    assert not query.isActive
    session.streams.resetTerminated()


def test_watermark_advances_with_rows_of_any_type(spark, session, make_events, tmp_path):
    """A crash is reported once later events, crashes or not, have closed its window."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.mkdir(source)
    crash = dict(event_type="crash_event")
    df = make_events(crash, dict(timestamp="2024-01-01T00:10:00"))
    drop(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")), source, "a", 100)
    spikes = windows.error_spikes(stream(session, source))
    jobs.run_to_end(jobs.write_parquet_stream(spikes, "quiet", out, str(tmp_path / "ck"), trigger=None))
    assert spark.read.schema("crash_count bigint").parquet(out).collect()[0][0] == 1


def test_console_sink(session, folder):
    query = jobs.write_console_stream(windows.tumbling_counts(stream(session, folder), "1 hour"), "console", trigger=None, mode="update")
    jobs.run_to_end(query)
    assert "console" in query.lastProgress.sink.description.lower()


def test_raw_landing_is_readable_by_the_batch_layer(spark, session, day, folder, tmp_path):
    from signalfold.sources.raw import load_raw_events

    out = str(tmp_path / "raw")
    jobs.run_to_end(jobs.land_raw_stream(stream(session, folder), out, str(tmp_path / "ck"), trigger=None))
    assert sorted(n for n in os.listdir(out) if n.startswith("topic=")) == ["topic=app_events", "topic=crashes", "topic=performance"]
    crashes = load_raw_events(spark, out, date="2024-01-02", fmt="parquet", topic="crashes")
    expected = day.where("event_type = 'crash_event'").count() + 1  # the late row lands too
    assert crashes.count() == expected
    plan = crashes._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[.*topic.*event_date", plan)
    # files that no finished batch has committed are not read
    stray = f"{out}/topic=crashes/event_date=2024-01-02/part-stray.parquet"
    pq.write_table(day.where("event_type = 'crash_event'").drop("event_type").toArrow(), stray)
    assert load_raw_events(spark, out, date="2024-01-02", fmt="parquet", topic="crashes").count() == expected


def test_open_window_waits_for_the_watermark(spark, session, make_events, tmp_path):
    source = str(tmp_path / "in")
    os.mkdir(source)
    start = datetime(2024, 1, 1)
    stamps = [start, start + timedelta(seconds=59), start + timedelta(seconds=69)]
    df = make_events(*[dict(timestamp=s.isoformat()) for s in stamps]).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    drop(df, source, "a", 100)
    out = str(tmp_path / "out")
    counts = windows.active_users_per_minute(stream(session, source))
    jobs.run_to_end(jobs.write_parquet_stream(counts, "open", out, str(tmp_path / "ck"), trigger=None))
    assert spark.read.schema("active_users bigint").parquet(out).count() == 0  # 69 s - 10 s < 60 s
