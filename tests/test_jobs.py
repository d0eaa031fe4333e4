"""The submittable jobs on message files, and settings from the environment."""

from dataclasses import replace

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from signalfold import jobs
from signalfold.functions.expressions import event_date
from signalfold.operators.usage import daily_usage_trends
from signalfold.settings import LakeSettings, Settings
from signalfold.sources.star import table, telemetry
from signalfold.sources.wire import encode, read_file_stream, stage_in_order, with_event_time
from signalfold.operators.windows import active_users_per_minute
from signalfold.streaming import jobs as streams


def test_settings_from_the_environment():
    env = {"SIGNALFOLD_LAKE_ROOT": "s3://lake", "SIGNALFOLD_KAFKA_BOOTSTRAP_SERVERS": "a:1, b:2", "SIGNALFOLD_COHORT_DAYS": "14", "HOME": "/x"}
    settings = Settings.from_env(env)
    assert settings.lake.batch == "s3://lake/processed/batch" and settings.kafka.bootstrap_servers == ("a:1", "b:2")
    assert settings.cohort_days == 14 and settings.stream == Settings().stream
    with pytest.raises(ValueError, match="SIGNALFOLD_LAKE_ROTO"):
        Settings.from_env({"SIGNALFOLD_LAKE_ROTO": "x"})


def test_stream_and_batch_jobs_run_to_their_end(spark, tmp_path):
    events = telemetry(spark, SF_DIR).where(event_date() < F.lit("2024-01-04").cast("date"))
    given = events.withColumn("payload", F.col("payload").withField("stack_trace", F.lit("t")).withField("unit", F.lit("ms")))
    messages = encode(given).select("value").union(spark.createDataFrame([("{broken",), ("",)], "value string"))
    messages.union(encode(given).select("value").limit(200)).coalesce(2).write.text(str(tmp_path / "in"))  # some come twice
    settings = replace(Settings(), lake=LakeSettings(root=str(tmp_path / "lake"), database="jobs_test"))
    session = streams.streaming_session(spark, 2)
    for query in jobs.stream(session, str(tmp_path / "ck"), settings, files=str(tmp_path / "in"), available_now=True):
        streams.run_to_end(query)
    landed = spark.read.parquet(settings.lake.raw)
    quarantined = landed.where("status = 'quarantined'").select("reason", "text").collect()
    assert sorted(map(tuple, quarantined)) == [("malformed", ""), ("malformed", "{broken")]
    assert len(jobs.batch(spark, settings)) == 11
    assert rows(spark.table("jobs_test.daily_trends").orderBy("date")) == rows(daily_usage_trends(events))
    assert spark.table("jobs_test.raw_crashes").count() == events.where("event_type = 'crash_event'").count()
    assert spark.read.parquet(f"{settings.lake.metrics}/active_users").count() > 0


def test_backlog_in_slices_drops_nothing_and_bounds_state(spark, tmp_path):
    """A table in files without any time order, replayed in slices."""
    facts = table(spark, SF_DIR, "events").withColumn("value", F.lit(0.0))
    facts.repartition(5).write.parquet(str(tmp_path / "unordered"))
    stage_in_order(spark.read.parquet(str(tmp_path / "unordered")), str(tmp_path / "slices"), "ts", 2500)
    session = streams.streaming_session(spark, 2)
    sliced = read_file_stream(session, str(tmp_path / "slices"), facts.schema, max_files_per_trigger=1)
    events = with_event_time(telemetry(session, SF_DIR, events=sliced), "10 seconds")
    query = streams.write_parquet_stream(active_users_per_minute(events), "sliced", str(tmp_path / "out"), str(tmp_path / "ck"), None)
    streams.run_to_end(query)
    progress = [op for p in query.recentProgress for op in p.stateOperators]
    assert sum(op.numRowsDroppedByWatermark for op in progress) == 0
    total = facts.count()
    assert max(op.numRowsTotal for op in progress) <= total / 4 + total / 40
    expected = active_users_per_minute(telemetry(spark, SF_DIR)).agg(F.sum("event_count")).first()[0]
    got = spark.read.parquet(str(tmp_path / "out")).agg(F.sum("event_count")).first()[0]
    assert expected - 5 <= got <= expected  # all but the windows that are still open
