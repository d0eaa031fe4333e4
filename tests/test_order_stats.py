"""Exact order statistics against sorting in Python."""

import random
import statistics

from pyspark.sql import functions as F

from signalfold.functions.order_stats import magnitude_bucket, values_at
from signalfold.operators.observe import run_latency_summary


def test_values_at_equals_sorting(spark):
    rng = random.Random(7)
    groups = {
        "hot": [12.5] * 400 + [rng.uniform(-50, 50) for _ in range(300)],
        "wide": [rng.choice((-1, 1)) * 10 ** rng.uniform(-9, 12) for _ in range(500)],
        "one": [3.0],
        "ints": [float(rng.randint(0, 20)) for _ in range(250)],
        None: [2.0, 1.0, 4.0],
    }
    data = [(k, v) for k, values in groups.items() for v in values] + [("one", None), ("empty", None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    picked = values_at(df, ["k"], "v", {"first": "0", "mid": "floor(n / 2)", "last": "n - 1", "beyond": "n"})
    got = {r.k: r for r in picked.collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        ordered = sorted(values)
        assert (got[k]["first"], got[k]["mid"], got[k]["last"], got[k]["beyond"]) == (
            ordered[0], ordered[len(ordered) // 2], ordered[-1], None,
        ), k


def test_bucket_rises_with_value(spark):
    values = sorted([-1e300, -5.0, -1e-12, 0.0, 1e-12, 0.001, 0.5, 1.0, 1.0000001, 7.0, 1e6, 1e300])
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", magnitude_bucket(F.col("v")).alias("b"))
    buckets = [r.b for r in df.orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_run_summary(spark, make_events):
    rng = random.Random(3)
    times = [rng.randint(1, 900) for _ in range(101)] + [rng.randint(1, 900) for _ in range(40)]
    events = make_events(
        *[dict(app_version="a" if i < 101 else "b", duration_ms=t) for i, t in enumerate(times)],
        dict(app_version="a", event_type="crash_event"), dict(app_version="c", event_type="crash_event"),
    )
    summary = run_latency_summary(
        events, "app_version", F.col("payload.duration_ms").cast("double"), F.col("event_type") == "crash_event"
    )
    got = {r.run: r for r in summary.collect()}
    for run, values in (("a", times[:101]), ("b", times[101:])):
        ordered = sorted(values)
        assert got[run].p50_ms == statistics.median(values)
        assert got[run].p95_ms == ordered[int(len(ordered) * 0.95)]
        assert got[run].p99_ms == ordered[int(len(ordered) * 0.99)]
    assert (got["a"].total_events, got["a"].errors, got["a"].error_rate) == (102, 1, 1 / 102)
    assert (got["c"].p50_ms, got["c"].p95_ms, got["c"].error_rate) == (0.0, 0.0, 1.0)
