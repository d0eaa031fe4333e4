"""Operators on hand-made rows: nulls, ties, empty input, zero divisors, bucket and window edges."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalfold.operators import crashes, features, observe, performance, quality, retention, serving, usage, windows
from signalfold.operators.activity import activity, device_days
from signalfold.plans import catalog
from signalfold.plans.batch import reports, roll_ups
from signalfold.sources.raw import on_date, union_topics

OPEN, USE, CRASH, PERF = "app_open", "feature_used", "crash_event", "performance_metric"


def test_daily_usage_counts_sessions_of_opens_only(make_events):
    events = make_events(
        dict(event_type=OPEN, session_id="s1"),
        dict(event_type=OPEN, session_id="s1", device_id="d2"),
        dict(event_type=USE, session_id="s9", device_id=None),
        dict(event_type=OPEN, session_id="s2", timestamp="2024-01-02T23:59:59"),
        dict(event_type=USE, timestamp=None),
    )
    assert rows(usage.daily_usage_trends(events)) == [
        (None, 1, 1, 0), (date(2024, 1, 1), 2, 3, 1), (date(2024, 1, 2), 1, 1, 1),
    ]


def test_regional_trends_keep_null_region(make_events):
    events = make_events(dict(region=None), dict(region=None, device_id="d2"), dict())
    assert rows(usage.daily_trends_by_region(events)) == [
        (date(2024, 1, 1), None, 2, 2), (date(2024, 1, 1), "us-east", 1, 1),
    ]


def test_feature_adoption_total_counts_the_unknown_device(make_events):
    events = make_events(
        dict(feature_name="a", duration_ms=100), dict(feature_name="a", duration_ms=None, device_id="d2"),
        dict(event_type=OPEN, device_id="d3"), dict(event_type=OPEN, device_id=None),
    )
    assert rows(features.feature_adoption_rates(events)) == [(date(2024, 1, 1), "a", 2, 2, 100.0, 0.5)]


def test_feature_adoption_of_nothing(make_events):
    assert rows(features.feature_adoption_rates(make_events(dict(event_type=OPEN)))) == []
    assert rows(features.feature_adoption_rates(make_events().limit(0))) == []


def test_feature_ranking_breaks_ties(make_events):
    events = make_events(
        dict(feature_name="b", interaction_count=1), dict(feature_name="a", interaction_count=3),
        dict(feature_name="c"), dict(feature_name="c"),
    )
    ranked = features.feature_ranking(events)
    assert [(r.feature_name, r.rank) for r in ranked.collect()] == [("c", 1), ("a", 2), ("b", 3)]
    assert dict(ranked.dtypes)["rank"] == "int"


def test_retention_bucket_edges(make_events):
    days = (1, 7, 8, 14, 15)  # 0, 6, 7, 13 and 14 days after the first
    events = make_events(*[dict(timestamp=f"2024-01-{d:02d}T12:00:00") for d in days], dict(device_id=None))
    assert rows(retention.retention_cohorts(events)) == [
        (date(2024, 1, 1), 0, 1), (date(2024, 1, 1), 7, 1), (date(2024, 1, 1), 14, 1),
    ]


def test_retention_rate(make_events):
    events = make_events(dict(), dict(device_id="d2"), dict(device_id="d2", timestamp="2024-01-09T00:00:00"))
    assert rows(retention.retention_rates(events)) == [
        (date(2024, 1, 1), 0, 2, 2, 1.0), (date(2024, 1, 1), 7, 1, 2, 0.5),
    ]


def test_first_seen_keeps_the_unknown_device(make_events):
    events = make_events(dict(device_id=None), dict(timestamp="2024-01-05T00:00:00"), dict(timestamp="2024-01-03T00:00:00"))
    assert set(rows(retention.device_first_seen(events))) == {(None, date(2024, 1, 1)), ("d1", date(2024, 1, 3))}
    assert usage.distinct_devices(events).count() == 2


def test_crash_analysis(make_events):
    events = make_events(
        dict(event_type=CRASH, is_fatal=True), dict(event_type=CRASH, is_fatal=None), dict(device_id="d2"),
        dict(event_type=CRASH, is_fatal=False, device_id=None),
        dict(event_type=CRASH, os=None, is_fatal=True),
        dict(app_version="2.3.0"),
    )
    assert rows(crashes.crash_analysis(events)) == [
        ("mobile", "iOS", "2.4.1", 3, 1, 1, 2, 0.5),
        ("mobile", None, "2.4.1", 1, 1, 1, None, None),  # no population for an unknown segment
    ]


def test_fatal_as_text(spark, make_events):
    events = make_events(dict(event_type=CRASH, is_fatal=True), dict(event_type=CRASH, is_fatal=False))
    text = events.withColumn("payload", F.create_map(F.lit("is_fatal"), F.col("payload.is_fatal").cast("string")))
    assert rows(crashes.crash_analysis(text)) == rows(crashes.crash_analysis(events))


def test_performance_skips_missing_values_in_percentiles(make_events):
    events = make_events(
        *[dict(event_type=PERF, metric_name="m", value=float(v)) for v in range(1, 101)],
        dict(event_type=PERF, metric_name="m", value=None), dict(event_type=USE, value=1e9),
    )
    assert rows(performance.device_performance_report(events)) == [
        ("mobile", "iOS", "2.4.1", 50.5, 50.0, 95.0, 99.0, 101)
    ]
    assert rows(performance.performance_by_metric(events))[0][3] == "m"


def test_text_that_is_no_number_is_null(make_events):
    events = make_events(dict(event_type=PERF, value=2.0), dict(event_type=PERF))
    text = events.withColumn("payload", F.create_map(F.lit("value"), F.coalesce(F.col("payload.value").cast("string"), F.lit("x")), F.lit("metric_name"), F.lit("m")))
    assert rows(performance.device_performance_report(text))[0][3:] == (2.0, 2.0, 2.0, 2.0, 2)


def test_reports_over_roll_ups_equal_reports_over_events(spark, make_events):
    events = make_events(
        dict(event_type=OPEN, session_id="s"), dict(feature_name="a", duration_ms=5, interaction_count=2),
        dict(feature_name="a", device_id="d2", timestamp="2024-01-09T10:00:00"), dict(event_type=CRASH, is_fatal=True),
        dict(event_type=PERF, metric_name="m", value=4.0), dict(event_type=CRASH, device_id=None, region=None),
        dict(event_type=OPEN, session_id=None, device_id="d3"), dict(timestamp=None, feature_name="b"),
    )
    rolled, plain = reports(events, rolled=roll_ups(events)), reports(events)
    for name in plain:
        assert set(rows(rolled[name])) == set(rows(plain[name])), name
    assert set(rows(plain["daily_trends"])) == set(rows(usage.daily_usage_trends(events)))
    assert set(rows(plain["feature_ranking"])) == set(rows(features.feature_ranking(events)))
    assert set(rows(plain["feature_adoption"])) == set(rows(features.feature_adoption_rates(events)))
    assert set(rows(plain["retention_cohorts"])) == set(rows(retention.retention_cohorts(events)))
    assert device_days(activity(events)).agg(F.sum("events")).first()[0] == 8


def test_on_date_is_a_whole_day(make_events):
    events = make_events(
        dict(timestamp="2024-01-01T23:59:59.999999"), dict(timestamp="2024-01-02T00:00:00"),
        dict(timestamp="2024-01-02T23:59:59.999999"), dict(timestamp="2024-01-03T00:00:00"), dict(timestamp=None),
    )
    assert [r.event_id for r in on_date(events, "2024-01-02").collect()] == ["1", "2"]


def test_union_fills_missing_columns_and_payload_fields(spark):
    a = spark.sql("select '1' as event_id, named_struct('session_id', 's') as payload")
    b = spark.sql("select '2' as event_id, 'r' as region, named_struct('value', 1.5D) as payload")
    both = union_topics(a, b).orderBy("event_id")
    assert rows(both.select("event_id", "region", "payload.session_id", "payload.value")) == [
        ("1", None, "s", None), ("2", "r", None, 1.5),
    ]


def test_windows_start_on_their_edge(make_events):
    events = make_events(
        dict(timestamp="2024-01-01T00:00:29.999999", event_type=CRASH), dict(timestamp="2024-01-01T00:00:30", event_type=CRASH),
        dict(timestamp="2024-01-01T00:01:00", event_type=CRASH, device_id=None), dict(timestamp=None, event_type=CRASH),
    )
    spikes = sorted(rows(windows.error_spikes(events)))
    at = lambda m, s: datetime(2024, 1, 1, 0, m, s)
    assert spikes == [
        (at(0, 0), at(0, 30), "iOS", "2.4.1", 1, 1), (at(0, 30), at(1, 0), "iOS", "2.4.1", 1, 1),
        (at(1, 0), at(1, 30), "iOS", "2.4.1", 1, 0),  # an unknown device is a crash but no device
    ]


def test_active_users_and_feature_usage(make_events):
    events = make_events(
        dict(feature_name="a"), dict(feature_name="a"), dict(feature_name="b", device_id="d2"),
        dict(event_type=OPEN, device_id=None),
    )
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1)
    assert rows(windows.active_users_per_minute(events)) == [(start, end, "us-east", "mobile", 2, 4)]
    assert sorted(rows(windows.feature_usage(events))) == [(start, end, "a", 2, 1), (start, end, "b", 1, 1)]


def test_spike_threshold_is_exclusive(make_events):
    events = make_events(dict(event_type=CRASH), *[dict() for _ in range(19)])
    assert rows(windows.spike_alerts(events, 0.05).select("error_rate", "is_spike")) == [(0.05, False)]
    assert rows(windows.spike_alerts(events, 0.04).select("crash_count", "event_count", "is_spike")) == [(1, 20, True)]


def test_week_over_week_counts_rows_not_days(spark):
    days = [(date(2024, 1, d), n, n, n) for d, n in zip((1, 2, 3, 4, 5, 6, 8, 9, 10), (0, 4, 4, 4, 4, 4, 4, 6, 6))]
    trends = spark.createDataFrame(days, catalog.REPORT_COLUMNS["daily_trends"])
    result = rows(catalog.week_over_week(spark, trends))
    assert result[0] == (date(2024, 1, 10), 6, 4, 50.0)  # eight days before: the 7th is missing
    assert result[1] == (date(2024, 1, 9), 6, 0, None)  # no change against nothing
    assert result[-1] == (date(2024, 1, 1), 0, None, None)


def test_serving_filters_and_limits(spark):
    trends = spark.sql("select date_add(date '2024-01-01', cast(id as int)) date, id daily_active_users, id total_events, id total_sessions from range(150)")
    assert serving.usage(trends).count() == 150 and serving.usage(trends, limit=100).count() == 100
    assert [r.date.day for r in serving.usage(trends, "2024-01-03", "2024-01-04").collect()] == [3, 4]
    segments = spark.sql("select 'mobile' device_type, concat('os', id) os, '1' app_version, id % 2 crash_count from range(60)")
    assert serving.crashes(segments).count() == 60 and serving.crashes(segments, limit=50).count() == 50
    assert rows(serving.crashes(segments, os="os3").select("crash_count")) == [(1,)]
    assert serving.crashes(segments, os="").count() == 60  # an empty filter filters nothing
    assert serving.crashes(segments, device_type="tablet").count() == 0


def test_usage_granularity_is_checked(make_events):
    with pytest.raises(ValueError):
        serving.usage_from_events(make_events(dict()), granularity="weekly")


def test_realtime_snapshot(make_events):
    events = make_events(
        dict(timestamp="2024-01-01T00:00:00"), dict(timestamp="2024-01-01T00:00:01", device_id="d2", event_type=CRASH),
        dict(timestamp="2024-01-01T00:01:00"),
    )
    assert rows(serving.realtime_snapshot(events)) == [(datetime(2024, 1, 1, 0, 1), 2, 2 / 60, 0.5)]
    assert rows(serving.realtime_snapshot(make_events(dict()).limit(0))) == [(None, 0, 0.0, None)]


def test_topic_routing(make_events):
    kinds = (OPEN, USE, CRASH, PERF, "other", None)
    routed = quality.with_topic(make_events(*[dict(event_type=k) for k in kinds]))
    assert [r.topic for r in routed.collect()] == ["app_events", "app_events", "crashes", "performance", "app_events", "app_events"]


def test_envelope_reasons(make_events):
    events = make_events(dict(), dict(event_type="x", device_type="watch"), dict(os=None, timestamp=None))
    reasons = [r.reason for r in events.select(quality.envelope_reason().alias("reason")).collect()]
    assert reasons == [None, "invalid:event_type,invalid:device_type", "missing:timestamp,missing:os"]
    valid, quarantine = quality.split_by_reason(events, quality.envelope_reason())
    assert valid.count() == 1 and quarantine.count() == 2


def test_os_rule(make_events):
    events = make_events(dict(), dict(os="Linux"), dict(device_type="desktop", os="macOS"), dict(device_type=None), dict(os=None))
    assert [r[0] for r in events.select(quality.os_is_consistent()).collect()] == [True, False, True, False, False]


def test_mix_and_coverage_list_what_is_absent(make_events):
    events = make_events(dict(event_type=OPEN), dict(event_type=OPEN), dict(event_type="x"), dict(event_type=CRASH))
    mix = {r.event_type: (r.event_count, r.share) for r in quality.event_mix(events).collect()}
    assert mix == {OPEN: (2, 0.5), USE: (0, 0.0), CRASH: (1, 0.25), PERF: (0, 0.0), "unexpected": (1, 0.25)}
    coverage = quality.region_coverage(events).collect()
    assert [(r.region, r.event_count) for r in coverage if r.present] == [("us-east", 4)]
    assert len(coverage) == 7 and coverage[-1][:2] == ("unexpected", 0) and not coverage[0].covered and coverage[0].regions_present == 1
    empty = quality.event_mix(events.limit(0)).collect()
    assert [r.share for r in empty] == [None] * 5


def test_reconcile_both_ways(spark):
    produced = spark.createDataFrame([("a",), ("b",), ("b",)], "event_id string")
    consumed = spark.createDataFrame([("b",), ("c",)], "event_id string")
    assert sorted(rows(quality.reconcile_ids(produced, consumed))) == [("a", "missing"), ("b", "matched"), ("c", "unexpected")]


def test_histogram_quantile_interpolates(spark):
    values = spark.createDataFrame([("x", v) for v in (0.5, 1.5, 1.6, 3.0)] + [("y", 9.0), ("z", None)], "k string, v double")
    estimate = observe.histogram_quantile(values, ["k"], F.col("v"), {"p0": 0.0, "p50": 0.5, "p100": 1.0}, (2, 1, 4))
    got = {r.k: (r.p0, r.p50, r.p100) for r in estimate.collect()}
    assert got["x"] == (0.0, 1.5, 4.0)
    assert got["y"][1:] == (4, 4)  # beyond the last bound
    assert got["z"] == (None, None, None)
    buckets = observe.histogram_buckets(values, ["k"], F.col("v"), (2, 1, 4))
    assert [(r.le, r.bucket_count) for r in buckets.collect() if r.k == "x"] == [("1", 1), ("2", 3), ("4", 4), ("+Inf", 4)]


def test_throughput_and_error_steps(make_events):
    events = make_events(*[dict(event_type=CRASH) for _ in range(3)], dict(timestamp="2024-01-01T00:05:00"))
    status = observe.throughput_status(events, ((0, "red"), (3, "green")), low=2, seconds=1).orderBy("window_start")
    silent = [("red", True)] * 4  # minutes without an event
    assert rows(status.select("status", "low_throughput")) == [("green", False), *silent, ("red", True)]
    errors = observe.error_rate(events, seconds=1).orderBy("window_start")
    assert rows(errors.select("error_count", "status")) == [(3, "yellow"), (0, "green")]


def test_latency_alerts_are_exclusive(spark):
    df = spark.createDataFrame([("a", 5000.0), ("b", 5001.0), ("c", 1.0), ("c", 9000.0)], "k string, ms double")
    got = {r.k: (r.mean_breach, r.p95_breach) for r in observe.latency_alerts(df, ["k"], F.col("ms")).collect()}
    assert got == {"b": (True, True), "c": (False, True)}


def test_wrong_clocks_do_not_stretch_the_panels(spark, make_events):
    """One device at the start of its clock and one far ahead: the panels have the windows of the others, the check has them."""
    day = [dict(timestamp=f"2024-01-01T00:{m:02d}:30") for m in (0, 5)]
    events = make_events(*day, dict(timestamp="1970-01-01T00:00:00"), dict(timestamp="9999-12-31T23:59:59"), dict(timestamp=None))
    assert observe.event_rate(events).count() == 6
    assert observe.throughput_status(events).count() == 6
    assert observe.error_rate(events).count() == 2
    assert dict(rows(observe.implausible_clocks(events))) == {"missing": 1, "early": 1, "ahead": 1}
    assert observe.event_rate(make_events(dict(timestamp=None))).count() == 0


def test_filled_windows_are_aligned_with_counted_ones(spark, make_events):
    """Seven minutes don't divide a day; each window occurs once, and none is off the grid."""
    events = make_events(*[dict(timestamp=t) for t in ("2024-01-01T23:50:00", "2024-01-02T00:20:00", "2024-01-04T12:00:00")])
    got = rows(observe.event_rate(events, "7 minutes", 420).select("window_start", "event_count").orderBy("window_start"))
    assert sum(n for _, n in got) == 3 and len({t for t, _ in got}) == len(got)
    assert {(b[0] - a[0]).total_seconds() for a, b in zip(got, got[1:])} == {420.0}
