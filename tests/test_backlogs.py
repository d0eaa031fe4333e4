"""What the replayed backlogs cost: no pass, join, shuffle or commit that another one has made already."""

import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from signalfold.operators.windows import active_users_per_minute, error_spikes, feature_usage
from signalfold.plans import registry, repair
from signalfold.settings import LakeSettings, Settings
from signalfold.sinks import batch as sinks
from signalfold.sources import wire
from signalfold.sources.wire import Pace
from signalfold.streaming import jobs
from signalfold.streaming.reconcile import reconcile_streams


@pytest.fixture
def tables(spark, tmp_path):
    """400 events, a minute and a half apart, of 7 customers, of whom one has no nation."""
    path = str(tmp_path / "tables")
    kinds = "element_at(array('signup', 'error', 'purchase', 'click'), CAST(id % 4 + 1 AS int))"
    spark.range(400).selectExpr(
        "id AS event_id", "CAST(timestamp_seconds(1704067200 + id * 90) AS timestamp_ntz) AS ts", "id % 7 AS user_id",
        f"{kinds} AS event_type", "CAST(id AS double) AS value", "concat('{\"k\": ', id % 11, '}') AS props",
    ).write.parquet(f"{path}/events.parquet")
    spark.range(7).selectExpr(
        "id AS c_custkey", "'c' AS c_name", "CAST(nullif(id % 3, 2) AS int) AS c_nationkey", "0D AS c_acctbal", "'BUILDING' AS c_mktsegment"
    ).write.parquet(f"{path}/customer.parquet")
    spark.range(2).selectExpr("CAST(id AS int) AS n_nationkey", "'n' AS n_name", "CAST(id AS int) AS n_regionkey").write.parquet(f"{path}/nation.parquet")
    spark.range(2).selectExpr("CAST(id AS int) AS r_regionkey", "concat('R', id) AS r_name").write.parquet(f"{path}/region.parquet")
    return path


def test_repeats_and_partners_meet_in_one_shuffle_a_side(spark, tmp_path):
    session = jobs.streaming_session(spark, 2, jobs.HEAP)
    for side in ("p", "c"):
        spark.range(20).selectExpr("CAST(id AS string) AS event_id", "timestamp_seconds(1704067200 + id) AS timestamp").write.parquet(str(tmp_path / side))
    sides = [wire.read_file_stream(session, str(tmp_path / side), spark.read.parquet(str(tmp_path / side)).schema) for side in ("p", "c")]
    query = jobs.write_rows_stream(reconcile_streams(*sides), "reconcile-plan", str(tmp_path / "out"), str(tmp_path / "checkpoint"), None)
    jobs.run_to_end(query)
    plan = query._jsq.explainInternal(False)
    assert "StreamingSymmetricHashJoin" in plan and plan.count("Exchange hashpartitioning") == 2
    assert {r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"matched"}


def test_known_quantiles_need_no_pass(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda k: (calls.add(1), k)[1], "long")
    facts = spark.range(0, 1000, 1, 4).select(F.timestamp_seconds(counted("id")).alias("timestamp"))
    made = wire.stage_in_order(facts, str(tmp_path / "staged"), "timestamp", 100, bounds=["1970-01-01 00:05:00", "1970-01-01 00:10:00"])
    assert made == 3 and calls.value == 1000 and spark.read.parquet(str(tmp_path / "staged")).count() == 1000
    assert wire.stage_in_order(facts, str(tmp_path / "whole"), "timestamp", 100, bounds=[]) == 1


def test_queries_that_run_together_share_the_state_partitions(spark):
    pace = Pace.of(100_000, 25_000, 2)
    wide = spark.newSession()
    wide.conf.set("spark.sql.shuffle.partitions", "100")
    width = lambda **how: int(registry._stream_session(wide, pace, **how).conf.get("spark.sql.shuffle.partitions"))
    assert width() == 12 and width(together=True) == 6
    # a micro-batch of a sixty-fold table is one wave of 12 tasks
    assert Pace.of(6_000_000, 25_000, 2).state_partitions == 12
    checksums = lambda store: jobs.streaming_session(spark, 2, store).conf.get("spark.sql.streaming.checkpoint.fileChecksum.enabled")
    assert checksums(jobs.HEAP) == "false" and checksums(jobs.ROCKSDB) == "true"


def test_rows_in_time_are_joined_with_their_devices_once(spark, tables, monkeypatch):
    plans, land = [], sinks.land_raw

    def landed(events, path):
        plans.append(events._jdf.queryExecution().optimizedPlan().toString())
        land(events, path)

    monkeypatch.setattr(sinks, "land_raw", landed)
    users = registry.repair_late_windows(spark, tables)
    assert ["Join" in plan for plan in plans] == [False, True]
    # every closed minute has all of its events, those that came late too
    got = {(str(r.window_start), r.region): r.event_count for r in users.collect()}
    closed = max(start for start, _ in got)
    events = registry.telemetry(spark, tables)
    expected = events.groupBy(F.date_trunc("minute", "timestamp").cast("timestamp_ntz").alias("m"), "region").count().collect()
    assert got == {(str(r.m), r.region): r["count"] for r in expected if str(r.m) <= closed} and len(got) > 390


def test_aggregates_are_repaired_at_the_same_time(spark, make_events, tmp_path, monkeypatch):
    settings = replace(Settings(), lake=LakeSettings(root=str(tmp_path)))
    events = make_events(*[dict(timestamp=f"2024-01-01T10:0{m}:10", event_type=t) for m in range(4) for t in ("feature_used", "crash_event")])
    events = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    sinks.land_raw(events, settings.lake.raw)
    for name, operator in (("active_users", active_users_per_minute), ("error_spikes", error_spikes), ("feature_usage", feature_usage)):
        operator(events).withColumn("window_date", F.to_date("window_start")).write.partitionBy("window_date").parquet(f"{settings.lake.metrics}/{name}")
    all_there, publish = threading.Barrier(3, timeout=60), repair.publish
    monkeypatch.setattr(repair, "publish", lambda df, path: (path.endswith("marks") or all_there.wait(), publish(df, path)))
    assert repair.repair_windows(spark, settings) is not None
