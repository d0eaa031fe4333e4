"""What the plans must and must not hold at scale."""

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from signalfold.plans.registry import QUERIES
from signalfold.sources.star import telemetry

WRITES = {
    "src_raw_events", "stream_all_topics", "sink_stream_parquet", "sink_roundtrip", "publish_keyed",
    "raw_landing", "archive_split", "stream_active_users", "stream_feature_usage", "stream_quarantine",
    "batch_layer",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|BatchEval|ArrowEval|RDDScan", text)


def test_day_filter_reaches_the_scan(spark):
    text = plan(QUERIES["scan_by_date"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in text and "LessThan(ts,2024-01-11T00:00)" in text


def test_scans_read_only_needed_columns(spark):
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["distinct_devices"](spark, SF_DIR)))
    assert schema == ["user_id:bigint"]
    assert "props" not in plan(QUERIES["tumbling_minute_counts"](spark, SF_DIR))


def test_dimension_is_broadcast_only_below_the_threshold(spark):
    events = telemetry(spark, SF_DIR)
    assert "SortMergeJoin" not in plan(events)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(telemetry(spark, SF_DIR).groupBy("region").count())
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distinct_devices_are_counted_in_two_steps(spark):
    """Partial aggregates come before both shuffles, so hot keys are combined in their tasks."""
    text = plan(QUERIES["active_users_per_minute"](spark, SF_DIR))
    steps = re.findall(r"HashAggregate|Exchange hashpartitioning|SortAggregate|Expand", text)
    # from the result down: final, exchange, partial, for each of the two steps
    assert steps == ["HashAggregate", "Exchange hashpartitioning", "HashAggregate"] * 2


def test_retention_needs_no_join(spark):
    assert "Join" not in plan(QUERIES["retention_rates"](spark, SF_DIR))


def test_crash_analysis_expands_nothing(spark):
    text = plan(QUERIES["crash_analysis"](spark, SF_DIR))
    assert "Expand" not in text and text.count("Scan parquet") == 2


def test_a_hot_key_join_is_split(spark):
    """A third of all rows on one key: the sort-merge join splits that key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        events = spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(8)
        hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
        joined = telemetry(spark, SF_DIR, region=False, events=hot)
        assert len(joined.collect()) == 10_000
        assert "isSkew=true" in joined._jdf.queryExecution().executedPlan().toString() or "skewed" in plan(joined)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
