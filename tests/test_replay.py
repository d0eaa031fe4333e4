"""The tables replayed as streams: few micro-batches however long the backlog is, and no table joined in each of them."""

import pytest
from conftest import SF_DIR
from oracle_compare import connect, differences
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalfold.plans import registry
from signalfold.plans.oracle import ORACLE
from signalfold.sources import wire
from signalfold.sources.star import telemetry
from signalfold.sources.wire import Pace
from signalfold.streaming import jobs

STREAMED = (
    "sink_stream_parquet", "stream_active_users", "stream_reconcile", "snapshot_from_speed_layer", "repair_late_windows",
    "stream_quarantine", "raw_landing", "stream_all_topics", "stream_dedup", "stream_feature_usage",
)


def test_pace_of_backlogs():
    assert Pace.of(0, 25_000, 2).files_per_trigger == 2
    assert Pace.of(100_000, 25_000, 2) == Pace(100_000, 25_000, 2, 12)
    for rows in (600_000, 6_000_000, 36_000_000, 60_000_000):
        pace = Pace.of(rows, 25_000, 2)
        assert -(-rows // (pace.file_rows * pace.files_per_trigger)) <= Pace.MICRO_BATCHES and pace.files_per_trigger <= Pace.FILES
    # a backlog that was staged as more files than asked for has no more micro-batches
    assert Pace.of(100_000, 25_000, 2).admitted(4) == 2 and Pace.of(100_000, 25_000, 2).admitted(211) == 106
    assert Pace.of(0, 25_000, 2).admitted(0) == 2
    # no micro-batch is larger than what a live stream lands at a time, so that state is bounded
    assert Pace.of(10**10, 25_000, 2).file_rows * Pace.FILES <= 8_000_000 + Pace.FILES


@pytest.mark.parametrize("name", STREAMED)
def test_micro_batches_are_few_and_join_no_table(spark, monkeypatch, name):
    monkeypatch.setattr(registry, "STAGED_ROWS", 200)
    run, batches, plans = jobs.run_to_end, [], []

    def observed(query):
        run(query)
        batches.append(query.lastProgress.batchId + 1)
        plans.append(query._jsq.explainInternal(False))

    monkeypatch.setattr(jobs, "run_to_end", observed)
    assert differences(registry.QUERIES[name](spark, SF_DIR), ORACLE[name], connect(SF_DIR)) == []
    # the rows of a range differ a little; the last one only closes windows
    assert batches and all(5 <= n <= Pace.MICRO_BATCHES + 2 for n in batches)
    assert not any("BroadcastHashJoin" in p or "SortMergeJoin" in p for p in plans)


def test_staging_computes_the_facts_once(spark, tmp_path):
    n, calls = 20_000, spark.sparkContext.accumulator(0)
    # many rows at one time, some without a time, one far off
    seconds = "CASE WHEN id < 100 THEN NULL WHEN id = 100 THEN 32503680000 WHEN id < 5000 THEN 1704100000 ELSE 1704067200 + id * 7919 % 100000 END"
    times = spark.range(0, n, 1, 8).selectExpr("id", f"CAST(timestamp_seconds({seconds}) AS timestamp_ntz) AS timestamp")
    counted = F.udf(lambda k: (calls.add(1), k)[1], T.LongType())
    path = str(tmp_path / "staged")
    made = wire.stage_in_order(times.withColumn("made", counted("id")), path, "timestamp", 1000, n, times.select("timestamp"))
    assert 15 <= made <= 17  # fewer than 20, as those of the common time are one
    assert calls.value == n
    place = F.col("_metadata.file_modification_time")
    time = F.col("timestamp").cast("timestamp")
    staged = spark.read.parquet(path).groupBy(place.alias("t")).agg(F.min(time), F.max(time), F.count("*"), F.count_if(time.isNull())).orderBy("t")
    files = [tuple(r)[1:] for r in staged.collect()]
    assert all(a[1] < b[0] for a, b in zip(files, files[1:]))
    assert files[0][3] == 100 and sum(f[2] for f in files) == n and sum(f[3] for f in files) == 100
    assert sorted(f[2] for f in files)[-2] <= 2200 and max(f[2] for f in files) < 7000


def test_staged_by_quantiles_without_broadcast_of_devices(spark):
    plan = telemetry(spark, SF_DIR, shuffled=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastExchange") <= 2 * plan.count("BroadcastHashJoin") and "c_custkey" in plan
    _, events = registry._event_stream(spark, SF_DIR, windows=True)
    assert events.columns == [*registry.SPEED_LAYER, "payload"] and events.schema["payload"].dataType.names == ["feature_name"]


def test_both_sides_of_the_reconciliation_are_counted_in_one_pass(spark):
    events = telemetry(spark, SF_DIR, device=False, region=False)
    sides = registry._two_sides(events.select("event_type", "payload.is_fatal"))
    counts = events.agg(*[F.count_if(kept) for kept in registry._sides(F.col("event_type"), F.col("payload.is_fatal"))]).first()
    assert [side.count() for side in sides] == list(counts)
