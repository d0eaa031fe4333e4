"""Repeats and missing ids on streams: what is dropped, what stays, how long the state lives."""

import os
import time
from dataclasses import replace
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from signalfold.operators.quality import reconcile_ids
from signalfold.settings import StreamSettings
from signalfold.sources.wire import read_file_stream
from signalfold.streaming import jobs
from signalfold.streaming.dedup import ARRIVAL, first_arrivals
from signalfold.streaming.reconcile import reconcile_streams

START = datetime(2024, 1, 1)
SCHEMA = f"event_id string, note string, timestamp timestamp, {ARRIVAL} timestamp"


@pytest.fixture(scope="module")
def session(spark):
    return jobs.streaming_session(spark, shuffle_partitions=2)


def drop(folder, name, rows, age):
    """A file of (event_id, note, seconds of the event, seconds of arrival)."""
    os.makedirs(folder, exist_ok=True)
    stamp = pa.timestamp("us", tz="UTC")
    at = [[START + timedelta(seconds=r[k]) for r in rows] for k in (2, 3)]
    columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), *(pa.array(x, stamp) for x in at)]
    pq.write_table(pa.table(columns, names=["event_id", "note", "timestamp", ARRIVAL]), f"{folder}/{name}.parquet")
    os.utime(f"{folder}/{name}.parquet", (time.time() - age,) * 2)


def source(session, folder):
    schema = session.createDataFrame([], SCHEMA).schema
    return read_file_stream(session, str(folder), schema, max_files_per_trigger=1)


def run(rows, tmp_path, name="q"):
    query = jobs.write_rows_stream(rows, name, str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-ck"), None)
    jobs.run_to_end(query)
    return query


def test_repeats_in_later_batches_and_after_a_restart_are_dropped(spark, session, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "a", [("1", "first", 0, 0), ("2", "first", 1, 1), ("1", "again", 0, 2)], 900)
    drop(folder, "b", [("2", "again", 1, 60), ("3", "first", -90_000, 61), (None, "x", 3, 61), (None, "x", 3, 62)], 800)
    once = lambda: first_arrivals(source(session, folder), within="10 minutes")
    run(once(), tmp_path)
    drop(folder, "c", [("1", "again", 0, 300), ("3", "again", -90_000, 301), ("4", "first", 9, 302)], 700)
    run(once(), tmp_path)
    landed = spark.read.parquet(str(tmp_path / "q-out"))
    got = sorted((r.event_id or "", r.note) for r in landed.collect())
    # an event that reports an old time is not late, and rows without an id are not one
    assert got == [("", "x"), ("", "x"), ("1", "first"), ("2", "first"), ("3", "first"), ("4", "first")]


def test_state_expires_with_arrival_time(spark, session, tmp_path):
    folder = tmp_path / "in"
    for hour in range(6):
        drop(folder, f"f{hour}", [(f"{hour}-{k}", "first", 0, 3600 * hour + k) for k in range(500)], 900 - 10 * hour)
    query = run(first_arrivals(source(session, folder), within="10 minutes"), tmp_path)
    kept = [op.numRowsTotal for p in query.recentProgress for op in p.stateOperators]
    assert max(kept) <= 1000 and kept[-1] <= 500  # of 3000 keys, the last hour's
    assert spark.read.parquet(str(tmp_path / "q-out")).count() == 3000


def test_batch_keeps_the_first_arrival(spark):
    rows = [("1", "b", START, START + timedelta(days=9)), ("1", "a", START, START), (None, "c", START, START), (None, "c", START, START)]
    got = first_arrivals(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.event_id or "", r.note) for r in got) == [("", "c"), ("", "c"), ("1", "a")]


def test_speed_layer_input_uses_its_own_watermark(spark, session, tmp_path):
    from signalfold.operators.windows import tumbling_counts

    folder = tmp_path / "in"
    drop(folder, "a", [("1", "x", 0, 0), ("2", "x", 5, 0), ("1", "x", 0, 0)], 900)
    drop(folder, "b", [("2", "x", 5, 0), ("3", "x", 600, 0)], 800)
    events = first_arrivals(source(session, folder).withWatermark("timestamp", "10 seconds"), arrival="timestamp", watermark=False)
    run(tumbling_counts(events, "1 minute"), tmp_path)
    assert [r.event_count for r in spark.read.parquet(str(tmp_path / "q-out")).collect()] == [2]


SIDES = {
    "p": [[("1", 0), ("2", 10), ("3", 20), ("1", 0)], [("4", 4000), ("5", 4001)], [("end", 9000)]],
    "c": [[("1", 30), ("9", 15)], [("4", 4200), ("2", 4001), ("4", 4200)], [("end", 9000)]],
}


@pytest.fixture
def sides(session, tmp_path):
    for name, batches in SIDES.items():
        for k, batch in enumerate(batches):
            drop(tmp_path / name, f"f{k}", [(i, "", at, at) for i, at in batch], 900 - 10 * k)
    return [source(session, tmp_path / name) for name in SIDES]


def test_verdicts_of_two_streams(spark, sides, tmp_path):
    settings = replace(StreamSettings(), reconcile_within="10 minutes")
    query = run(reconcile_streams(*sides, settings=settings), tmp_path)
    got = sorted((r.event_id, r.status) for r in spark.read.parquet(str(tmp_path / "q-out")).collect())
    # 2 arrived an hour after it was produced: out of the bound on both sides
    assert got == [("1", "matched"), ("2", "missing"), ("2", "unexpected"), ("3", "missing"), ("4", "matched"), ("5", "missing"), ("9", "unexpected"), ("end", "matched")]
    state = [sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress]
    assert state[-1] <= 8  # the closed times have left


def test_streams_and_batches_agree(spark, sides, tmp_path):
    settings = replace(StreamSettings(), reconcile_within="10 hours")
    run(reconcile_streams(*sides, settings=settings), tmp_path)
    streamed = {(r.event_id, r.status) for r in spark.read.parquet(str(tmp_path / "q-out")).where("status = 'matched'").collect()}
    tables = [spark.read.parquet(str(tmp_path / name)) for name in SIDES]
    batch = {(r.event_id, r.status) for r in reconcile_streams(*tables, settings=settings).collect()}
    assert batch == {(r.event_id, r.status) for r in reconcile_ids(*tables).collect()}
    assert streamed == {r for r in batch if r[1] == "matched"}
