"""Rates, histograms and alerts over the event data, as the dashboards show them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalfold.functions.expressions import is_type, ratio, step_label, topic_of
from signalfold.functions.order_stats import values_at
from signalfold.settings import AlertSettings

_ALERTS = AlertSettings()
INFINITE = "+Inf"
PLAUSIBLE_SINCE = "2000-01-01"  # no device has sent an event before


def _seconds(width: str) -> int:
    """The length of a window such as ``5 minutes``."""
    number, unit = width.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}[unit.rstrip("s")]


def _windows(spark: SparkSession, first: Column, last: Column, seconds: int) -> DataFrame:
    """``window_start`` of every window from the day of ``first`` to that of ``last``: the days are spread over tasks, and the
    windows that begin in a day are a short array, so no row holds the whole range."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(first), F.to_date(last), F.expr("INTERVAL 1 DAY"))).alias("day"))
    # windows are counted from 1970 on, whatever part of a day they take
    offset = F.pmod(-F.unix_date("day").cast("bigint") * 86_400, F.lit(seconds))
    starts = days.repartition("day").select("day", F.explode(F.sequence(offset, F.lit(86_399).cast("bigint"), F.lit(seconds).cast("bigint"))).alias("s"))
    return starts.select((F.col("day").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("s"))).alias("window_start"))


def plausible(since: str = PLAUSIBLE_SINCE, ahead_days: int = 1) -> Column:
    """Whether the event's clock is one a device can have: not before ``since``, not more than ``ahead_days`` after today."""
    day = F.to_date("timestamp")
    return F.coalesce((day >= F.lit(since).cast("date")) & (day <= F.date_add(F.current_date(), ahead_days)), F.lit(False))


def implausible_clocks(events: DataFrame, since: str = PLAUSIBLE_SINCE, ahead_days: int = 1) -> DataFrame:
    """``reason, event_count`` of the events that the rate panels leave out: ``missing``, ``early`` or ``ahead`` of the plausible range.
    A reason without an event has a row with 0."""
    day = F.to_date("timestamp")
    reasons = {
        "missing": F.col("timestamp").isNull(),
        "early": day < F.lit(since).cast("date"),
        "ahead": day > F.date_add(F.current_date(), ahead_days),
    }
    counted = events.agg(*[F.count_if(rule).alias(name) for name, rule in reasons.items()])
    rows = [F.struct(F.lit(name).alias("reason"), F.col(name).alias("event_count")) for name in reasons]
    return counted.select(F.inline(F.array(*rows)))


def _filled(counts: DataFrame, keys: Sequence[str], numbers: Sequence[str], width: str) -> DataFrame:
    """``counts`` by ``window_start`` and ``keys``, with a row of zeros for each window between the first
    and the last of all that has none.

    There is a row per key and window of the time range, whatever the number of events. The range is that of plausible
    clocks, so one wrong clock does not stretch it; its ends are scalar subqueries over the counts.
    """
    first = counts.agg(F.min("window_start").alias("first")).scalar()
    last = counts.agg(F.max("window_start").alias("last")).scalar()
    stamp = counts.schema["window_start"].dataType
    series = _windows(counts.sparkSession, first, last, _seconds(width)).select(F.col("window_start").cast(stamp).alias("window_start"))
    series = series.where((F.col("window_start") >= first) & (F.col("window_start") <= last))
    zeros = [F.lit(0).cast("bigint").alias(n) for n in numbers]
    if keys:
        # a key has a row of its own with each window; the kinds of a panel are few
        kinds = counts.select(*keys).distinct().agg(F.collect_list(F.struct(*keys)).alias("_kinds")).scalar()
        silent = series.select("window_start", F.inline(kinds)).select("window_start", *keys, *zeros)
    else:
        silent = series.select("window_start", *zeros)
    return counts.unionAll(silent).groupBy("window_start", *keys).agg(*[F.max(n).alias(n) for n in numbers])


def event_rate(events: DataFrame, width: str = "1 minute", seconds: int = 60) -> DataFrame:
    """``window_start, topic, event_type, event_count, events_per_second``; ``seconds`` is the
    length of ``width``. A type that occurs at all has a row for every window of the time range."""
    counts = (
        events.where(plausible())
        .groupBy(F.window("timestamp", width), topic_of().alias("topic"), "event_type")
        .agg(F.count("*").alias("event_count"))
        .select(F.col("window.start").alias("window_start"), "topic", "event_type", "event_count")
    )
    rate = (F.col("event_count") / F.lit(float(seconds))).alias("events_per_second")
    filled = _filled(counts, ["topic", "event_type"], ["event_count"], width)
    return filled.select("window_start", "topic", "event_type", "event_count", rate)


def throughput_status(
    events: DataFrame,
    steps: Sequence[tuple[float, str]] = _ALERTS.throughput_steps,
    low: float = _ALERTS.min_events_per_second,
    width: str = "1 minute",
    seconds: int = 60,
) -> DataFrame:
    """``window_start, events_per_second, status, low_throughput``; a silent window has a row with rate 0, so
    that an outage is seen."""
    rate = F.col("n") / F.lit(float(seconds))
    counts = (
        events.where(plausible())
        .groupBy(F.window("timestamp", width))
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), "n")
    )
    return (
        _filled(counts, [], ["n"], width)
        .select("window_start", rate.alias("events_per_second"))
        .withColumn("status", step_label(F.col("events_per_second"), steps))
        .withColumn("low_throughput", F.col("events_per_second") < F.lit(float(low)))
    )


def error_rate(
    events: DataFrame,
    steps: Sequence[tuple[float, str]] = _ALERTS.error_steps,
    width: str = "5 minutes",
    seconds: int = 300,
) -> DataFrame:
    """``window_start, error_count, errors_per_second, status``; a window without errors, or without any
    event, has a row too."""
    counts = (
        events.where(plausible())
        .groupBy(F.window("timestamp", width))
        .agg(F.count_if(is_type("crash_event")).alias("error_count"))
        .select(F.col("window.start").alias("window_start"), "error_count")
    )
    rate = (F.col("error_count") / F.lit(float(seconds))).alias("errors_per_second")
    filled = _filled(counts, [], ["error_count"], width).select("window_start", "error_count", rate)
    return filled.withColumn("status", step_label(F.col("errors_per_second"), steps))


def _cumulative(df: DataFrame, keys: Sequence[Column | str], value: Column, bounds: Sequence[float]) -> DataFrame:
    """Per group the number of values at or below each bound (``_le0`` ...) and of all (``_all``)."""
    below = [F.count_if(value <= F.lit(float(b))).alias(f"_le{i}") for i, b in enumerate(bounds)]
    return df.groupBy(*keys).agg(*below, F.count(value).alias("_all"))


def histogram_buckets(
    df: DataFrame, keys: Sequence[str], value: Column, bounds: Sequence[float] = _ALERTS.latency_bounds
) -> DataFrame:
    """Cumulative histogram: the keys, ``le`` (upper bound as text, ``+Inf`` last), ``bucket_count``."""
    bounds = sorted(bounds)
    labelled = [
        F.struct(F.lit(str(b)).alias("le"), F.col(f"_le{i}").alias("bucket_count")) for i, b in enumerate(bounds)
    ]
    labelled.append(F.struct(F.lit(INFINITE).alias("le"), F.col("_all").alias("bucket_count")))
    return _cumulative(df, keys, value, bounds).select(*keys, F.inline(F.array(*labelled)))


def histogram_quantile(
    df: DataFrame,
    keys: Sequence[Column | str],
    value: Column,
    quantiles: dict[str, float],
    bounds: Sequence[float] = _ALERTS.latency_bounds,
) -> DataFrame:
    """Quantiles estimated from the histogram, by linear interpolation inside the bucket that holds
    the rank. The first bucket starts at 0; a rank beyond the last bound gives that bound; a group
    without values gives null. The raw values never leave their task: a group is a row of counts.
    """
    bounds = sorted(float(b) for b in bounds)
    counts = _cumulative(df, keys, value, bounds)
    names = [c for c in counts.columns if not c.startswith("_")]

    def estimate(q: float) -> Column:
        rank = F.lit(float(q)) * F.col("_all")
        result = F.when(F.col("_all") == 0, F.lit(None).cast("double"))
        for i, upper in enumerate(bounds):
            lower = bounds[i - 1] if i else 0.0
            before = F.col(f"_le{i - 1}") if i else F.lit(0)
            inside = F.try_divide(rank - before, (F.col(f"_le{i}") - before).cast("double"))
            result = result.when(F.col(f"_le{i}") >= rank, F.lit(lower) + F.lit(upper - lower) * inside)
        return result.otherwise(F.lit(bounds[-1]))

    return counts.select(*names, *[estimate(q).alias(name) for name, q in quantiles.items()])


def events_by_topic(events: DataFrame) -> DataFrame:
    """``topic, event_count, share``; each event counts once. The total is a window over the three
    topics' counts, so the events are read once."""
    counts = events.groupBy(topic_of().alias("topic")).agg(F.count("*").alias("event_count"))
    total = F.sum("event_count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", ratio(F.col("event_count"), total))


def latency_alerts(
    df: DataFrame, keys: Sequence[str], latency: Column, max_latency_ms: float = _ALERTS.max_latency_ms
) -> DataFrame:
    """The keys, ``mean_ms, p95_ms, mean_breach, p95_breach`` of the groups that break the limit."""
    limit = F.lit(float(max_latency_ms))
    return (
        df.groupBy(*keys)
        .agg(F.avg(latency).alias("mean_ms"), F.percentile_approx(latency, 0.95).alias("p95_ms"))
        .withColumn("mean_breach", F.col("mean_ms") > limit)
        .withColumn("p95_breach", F.col("p95_ms") > limit)
        .where(F.col("mean_breach") | F.col("p95_breach"))
    )


def run_latency_summary(events: DataFrame, run: str, latency: Column, error: Column) -> DataFrame:
    """Per run: ``total_events, errors, error_rate, p50_ms, p95_ms, p99_ms``.

    p50 is the median (mean of the middle two); p95 and p99 are the sorted value at 0-based index
    ``int(n * p)``. All are exact; a run without latencies has 0. A latency that is no number (NaN) is no latency
    and counts as an error.
    """
    bad = F.coalesce(F.isnan(latency.cast("double")), F.lit(False))
    rows = events.select(F.col(run).alias("run"), latency.alias("latency"), (error | bad).alias("error"))
    totals = rows.groupBy("run").agg(
        F.count("*").alias("total_events"), F.count_if(F.col("error")).alias("errors")
    )
    picked = values_at(
        rows, ["run"], "latency",
        {
            "_low": "floor((n - 1) / 2)",
            "_high": "floor(n / 2)",
            "p95_ms": "floor(n * 0.95D)",
            "p99_ms": "floor(n * 0.99D)",
        },
    ).withColumnRenamed("run", "_run")
    zero = F.lit(0.0)
    return totals.join(picked, F.col("run").eqNullSafe(F.col("_run")), "left").select(
        "run",
        "total_events",
        "errors",
        ratio(F.col("errors"), F.greatest("total_events", F.lit(1))).alias("error_rate"),
        F.coalesce((F.col("_low") + F.col("_high")) / 2, zero).alias("p50_ms"),
        F.coalesce(F.col("p95_ms").cast("double"), zero).alias("p95_ms"),
        F.coalesce(F.col("p99_ms").cast("double"), zero).alias("p99_ms"),
    )
