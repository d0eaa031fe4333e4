"""Every operator as a query over the star-schema tables: ``name -> f(spark, sf_dir)``.

Figures that add up doubles are rounded to six places here, since the order of addition, and with it
the last bits, differs between engines and runs; the operators themselves do not round.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalfold.functions.expressions import bucket_start, event_date, is_fatal, is_type
from signalfold.operators import crashes, device_bitmaps, features, observe, performance, quality, retention, serving, sketches, usage, windows
from signalfold.plans import catalog, device_tables, repair
from signalfold.plans.batch import REPORT_ROLL_UPS, extend_bitmaps, extend_roll_ups, run_batch, stored
from signalfold.schema import PAYLOAD_TYPES, SEGMENT, event_schema, normalise
from signalfold.session import workspace
from signalfold.settings import AlertSettings, LakeSettings, LookupSettings, Settings, StreamSettings
from signalfold.sinks import batch as sinks
from signalfold.sinks.versions import read_current
from signalfold.sources import lookup, open_payload, raw, wire
from signalfold.sources.star import K, table, telemetry
from signalfold.sources.wire import Pace
from signalfold.streaming import dedup, jobs
from signalfold.streaming.reconcile import reconcile_streams

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values: parameters of the registered queries, as in their SQL ----
DAY = "2024-01-10"
RANGE = ("2024-01-05", "2024-01-20")
REGION = "ASIA"
AS_OF = date(2024, 1, 31)
ARCHIVE_DAYS = 15
EXPECTED_REGIONS = ("AFRICA", "AMERICA", "ANTARCTICA", "ASIA", "EUROPE", "MIDDLE EAST")
# events per second of one and three events a minute, where the test data changes colour
THROUGHPUT_STEPS = ((0, "red"), (2 / 60, "yellow"), (3 / 60, "green"))
LOW_THROUGHPUT = 2 / 60
ERROR_STEPS = ((0, "green"), (1 / 300, "yellow"), (2 / 300, "red"))
# the column of each report that the batch-layer check adds up
REPORT_TOTALS = {
    "daily_trends": "total_sessions",
    "regional_trends": "daily_active_users",
    "feature_adoption": "unique_users",
    "feature_ranking": "rank",
    "retention_cohorts": "retained_users",
    "device_performance": "sample_count",
    "performance_by_metric": "sample_count",
    "crash_analysis": "affected_devices",
}
STAGED_ROWS = 25_000  # rows of a file at least, as which the table is replayed as a stream
FILES_PER_TRIGGER = 2  # such files of a micro-batch, at least
SPEED_LAYER = ("event_type", "timestamp", "device_id", "device_type", "os", "app_version", "region")  # and the feature's name
REPEATED_AFTER = "INTERVAL 5 MINUTES"  # when a message comes again
CLOSED = "INTERVAL 1 HOUR"  # before the end of the streams, by when all verdicts are out
SPLIT_DAY = "2024-01-15"  # first day of the second landing
LIFECYCLE_DAY = date(2024, 1, 20)
DEVICE_BUCKETS = 8
EVENT_IDS = tuple(str(97 * i) for i in range(100))  # of the lookup
DEVICE_IDS = tuple(str(7 * i) for i in range(20))
LOOKUP = LookupSettings(row_group_bytes=64 << 10, filter_bytes=64 << 10)  # the test tables are one row group otherwise
AS_OF_DATES = (date(2024, 1, 26), date(2024, 1, 31))
# -----------------------------------------------------------------------------

def _full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir)


def _no_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir, device=False, region=False)


def _devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir, region=False)


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir, device=False)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    """Time-zone-less timestamps, as the tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- sources ----------------------------------------------------------------


def src_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "raw-json")
    body = _full(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", wire.TIMESTAMP_FORMAT))
    body.write.json(path)
    return _flat(_naive(raw.load_raw_events(spark, path), "timestamp"))


def _flat(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "event_type", F.col("timestamp").alias("event_time"), "device_id", "device_type", "os",
        "app_version", "region", *[F.col(f"payload.{name}").alias(name) for name in PAYLOAD_TYPES],
    ).drop("stack_trace", "unit", "screen_name")


def scan_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.on_date(_no_dims(spark, sf_dir), DAY).select(
        "event_id", "event_type", F.col("timestamp").alias("event_time"), "device_id"
    )


def src_decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = wire.encode(_full(spark, sf_dir))
    decoded = wire.decode(messages.select(F.col("value").cast("binary").alias("value")), timestamp_type="timestamp_ntz")
    return _flat(normalise(decoded))


def table_raw_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = catalog.raw_views(quality.with_topic(_no_dims(spark, sf_dir)))
    parts = [
        f"SELECT '{view}' AS table_name, event_type, count(*) AS event_count FROM {view} GROUP BY event_type"
        for view in views.values()
    ]
    return spark.sql(" UNION ALL ".join(parts))


def _event_stream(
    spark: SparkSession,
    sf_dir: str,
    events: DataFrame | None = None,
    windows: bool = False,
    staged: str | None = None,
    together: bool = False,
) -> tuple[Pace, DataFrame]:
    """Telemetry as a stream over the events table (or ``events`` of it), in a session with streaming settings. The table is a
    backlog, so it is replayed in files of rising event time, some per micro-batch: state holds those, and no row is late. What the
    events say of their devices is joined before, once and not in every micro-batch. With ``windows``, the stream has what
    the speed layer reads, and nothing else is staged. The files go to ``staged``, if given."""
    events = table(spark, sf_dir, "events") if events is None else events
    pace = Pace.of(events.count(), STAGED_ROWS, FILES_PER_TRIGGER)
    facts = telemetry(spark, sf_dir, events=events, shuffled=True)
    if windows:
        facts = facts.select(*SPEED_LAYER, F.struct("payload.feature_name").alias("payload"))
    times = events.select(F.col("ts").alias("timestamp"))
    return pace, _replayed(_stream_session(spark, pace, together), facts, "timestamp", pace, times, staged=staged)


def _stream_session(spark: SparkSession, pace: Pace, together: bool = False) -> SparkSession:
    """``together``: its queries run at the same time and fill the cluster with half the state partitions each. A partition costs a
    commit per state store and micro-batch, most of it a wait for the file system, however few its rows are."""
    partitions = -(-pace.state_partitions // 2) if together else pace.state_partitions
    return jobs.streaming_session(spark, min(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions), jobs.HEAP)


def _replayed(
    session: SparkSession,
    facts: DataFrame,
    column: str,
    pace: Pace,
    times: DataFrame | None = None,
    bounds: Sequence[str] | None = None,
    staged: str | None = None,
) -> DataFrame:
    staged = staged or workspace(facts.sparkSession, "event-files")
    files = wire.stage_in_order(facts, staged, column, pace.file_rows, pace.rows, times, bounds)
    return wire.read_file_stream(session, staged, facts.schema, max_files_per_trigger=pace.admitted(files))


def _landed(spark: SparkSession, events: DataFrame, pace: Pace) -> DataFrame:
    """A stream of events, landed to its end and read back."""
    path, checkpoint = workspace(spark, "landing"), workspace(spark, "landing-checkpoint")
    jobs.run_to_end(jobs.land_raw_stream(events, path, checkpoint, trigger=None, files_per_folder=pace.files_per_trigger))
    return spark.read.parquet(path)


def stream_all_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded messages of all topics through one stream: decoded, routed, landed."""
    pace, events = _event_stream(spark, sf_dir)
    decoded = normalise(wire.decode(wire.encode(events)))
    landed = _landed(spark, decoded, pace)
    return landed.groupBy("topic", "event_type", "event_date").agg(
        F.count("*").alias("event_count"), F.countDistinct("device_id").alias("devices")
    )


# --- sinks ------------------------------------------------------------------


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pace, events = _event_stream(spark, sf_dir)
    landed = _landed(spark, events, pace)
    return landed.select(
        "event_id", "topic", "event_date", "event_type", "device_id", "region", *_payload(),
    )


def _payload() -> list:
    """The payload fields that the tables give."""
    return [F.col(f"payload.{n}").alias(n) for n in PAYLOAD_TYPES if n not in ("stack_trace", "unit", "screen_name")]


def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, of which some are cut short or no object, checked and landed in two runs, split by day; what was
    landed as valid gives the daily trends and the use of each feature."""
    events, path = _full(spark, sf_dir), workspace(spark, "checked-landing")
    # the tables give no stack trace or unit, which the rules ask for
    given = events.withColumn(
        "payload", F.col("payload").withField("stack_trace", F.lit("at top")).withField("unit", F.lit("ms"))
    )
    day = F.col("timestamp") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    for part in (given.where(day), given.where(~day)):
        n = F.col("event_id").cast("bigint")
        messages = wire.encode(part.withColumn("device_id", F.when(n % 10 != 9, F.col("device_id"))))
        number = F.get_json_object("value", "$.event_id").cast("bigint")
        faulty = messages.withColumn("value", F.when(number % 10 == 7, F.substring("value", 1, 20)).otherwise(F.col("value")))
        sinks.write_checked(quality.check_messages(faulty), path)
    landed = raw.load_raw_events(spark, path, fmt="parquet", checked=True)
    trends = usage.daily_usage_trends(landed, ordered=False)
    adopted = features.feature_adoption_rates(landed, ordered=False)
    return trends.select(
        F.col("date"), F.lit(None).cast("string").alias("feature_name"), F.col("daily_active_users").alias("users"),
        F.col("total_events").alias("events"), "total_sessions",
    ).unionByName(
        adopted.select(
            "date", "feature_name", F.col("unique_users").alias("users"), F.col("total_usage").alias("events"),
            F.lit(None).cast("bigint").alias("total_sessions"),
        )
    )


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which every tenth comes again five minutes later, landed through the dedup state."""
    facts = table(spark, sf_dir, "events").withColumn("arrival", F.col("ts").cast("timestamp"))
    again = facts.where("event_id % 10 = 0").withColumn("arrival", F.col("arrival") + F.expr(REPEATED_AFTER))
    both = facts.unionAll(again)
    pace = Pace.of(both.count(), STAGED_ROWS, FILES_PER_TRIGGER)
    sent = _replayed(_stream_session(spark, pace), both, "arrival", pace)
    arrival = sent.select("event_id", "ts", "user_id", "event_type", "value", "props", F.col("arrival").alias(dedup.ARRIVAL))
    once = dedup.first_arrivals(arrival).drop(dedup.ARRIVAL)
    path, checkpoint = workspace(spark, "once"), workspace(spark, "once-checkpoint")
    jobs.run_to_end(jobs.write_rows_stream(once, "dedup", path, checkpoint, None))
    # what the events say of their devices is joined once, not in every micro-batch
    raw_path = workspace(spark, "landing")
    sinks.land_raw(telemetry(spark, sf_dir, events=spark.read.schema(once.schema).parquet(path), shuffled=True), raw_path)
    landed = spark.read.parquet(raw_path)
    return landed.select("event_id", "topic", "event_type", "event_date", "device_id")


def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`reconcile_ids` on two streams, as far as they have closed: what arrives does so within three minutes."""
    events = table(spark, sf_dir, "events")
    facts = telemetry(spark, sf_dir, device=False, region=False, events=events).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    produced, consumed = (side.select("event_id", "timestamp") for side in _two_sides(facts.select("event_id", "event_type", "timestamp", "payload.is_fatal")))
    lag = F.make_dt_interval(secs=F.pmod(F.col("event_id").cast("bigint"), F.lit(180)).cast("decimal(18,6)"))
    consumed = consumed.withColumn("timestamp", F.col("timestamp") + lag)
    # one pass counts both sides, finds their ranges and their ends; a side has at most as many files as all events would have
    most = Pace.of(events.count(), STAGED_ROWS, FILES_PER_TRIGGER)
    ranges = -(-most.rows // most.file_rows)
    kept = _sides(F.col("event_type"), F.col("payload.is_fatal"))
    sent = facts.select(F.when(kept[0], F.col("timestamp")).alias("p"), F.when(kept[1], F.col("timestamp") + lag).alias("c"), *(k.alias(n) for n, k in zip(("p_kept", "c_kept"), kept)))
    found = sent.agg(
        *(
            F.struct(F.count_if(f"{side}_kept").alias("rows"), wire.quantile_cuts(F.col(side), ranges).alias("cuts"), F.unix_micros(F.max(side)).alias("end"))
            for side in ("p", "c")
        )
    ).first()
    paces = [Pace.of(side["rows"], STAGED_ROWS, FILES_PER_TRIGGER) for side in found]
    session = _stream_session(spark, max(paces, key=lambda p: p.rows))

    def replayed(side: DataFrame, pace: Pace, cuts: Sequence[str] | None) -> DataFrame:
        return _replayed(session, side, "timestamp", pace, bounds=cuts or [])

    with ThreadPoolExecutor(max_workers=2) as pool:
        verdicts = reconcile_streams(*pool.map(inheritable_thread_target(spark)(replayed), (produced, consumed), paces, [side["cuts"] for side in found]))
    path, checkpoint = workspace(spark, "reconciled"), workspace(spark, "reconciled-checkpoint")
    jobs.run_to_end(jobs.write_rows_stream(verdicts, "reconcile", path, checkpoint, None))
    closed = F.timestamp_micros(F.least(*[F.lit(side["end"]).cast("bigint") for side in found])) - F.expr(CLOSED)
    return spark.read.schema(verdicts.schema).parquet(path).where(F.col("event_time") < closed).select("event_id", "status")


def _two_sides(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Crashes and app opens were produced; all but fatal crashes, and performance samples, arrived."""
    produced, arrived = _sides(F.col("event_type"), F.col("is_fatal"))
    return events.where(produced), events.where(arrived)


def _sides(event_type: Column, fatal: Column) -> tuple[Column, Column]:
    both = event_type.isin("crash_event", "app_open")
    return both, (both & ~F.coalesce(fatal, F.lit(False))) | (event_type == "performance_metric")


def _closed_windows(name: str) -> Query:
    """A speed-layer aggregate through the streaming sink, read back: the windows that the watermark
    has closed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, events = _event_stream(spark, sf_dir, windows=True)
        events = wire.with_event_time(events, StreamSettings().watermark)
        path, checkpoint = workspace(spark, name), workspace(spark, f"{name}-checkpoint")
        jobs.run_to_end(jobs.write_parquet_stream(jobs.speed_layer(events, events)[name], name, path, checkpoint, None))
        return _naive(spark.read.parquet(path), "window_start", "window_end")

    return query


def repair_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speed layer over the rows that come in time; a tenth of all is landed later, and the windows are repaired."""
    settings = Settings(lake=LakeSettings(root=workspace(spark, "lake")))
    facts = table(spark, sf_dir, "events")
    late = F.col("event_id") % 10 == 3
    # the rows in time are staged with all that is landed of them, so that their devices are joined once
    staged = workspace(spark, "event-files")
    _, sent = _event_stream(spark, sf_dir, facts.where(~late), staged=staged, together=True)
    in_time, after = spark.read.schema(sent.schema).parquet(staged), telemetry(spark, sf_dir, events=facts.where(late), shuffled=True)
    sent = wire.with_event_time(sent, settings.stream.watermark)
    queries = jobs.start_speed_layer(sent, sent, settings.lake.metrics, workspace(spark, "checkpoints"), settings.stream, True)
    # the landing is another job, which runs beside the speed layer
    for part in (in_time, after):
        sinks.land_raw(part.withColumn("timestamp", F.col("timestamp").cast("timestamp")), settings.lake.raw)
        if not repair.last_mark(spark, settings.lake):
            repair.set_mark(spark, settings.lake, repair.landed_since(spark, settings.lake, None).agg(F.max("file_time")).first()[0])
    for query in queries:
        jobs.run_to_end(query)
    repair.repair_windows(spark, settings)
    users = repair.repaired_windows(spark, "active_users", settings.lake).drop("window_date")
    return _naive(users, "window_start", "window_end")


def _lake(spark: SparkSession, sf_dir: str, *reports: str) -> LakeSettings:
    """A new lake with the reports of the tables (all, or those named), whose roll-ups are extended in two steps, by days."""
    lake, events = LakeSettings(root=workspace(spark, "lake")), _full(spark, sf_dir)
    first, rest = _two_parts(events)
    names = reports or tuple(REPORT_ROLL_UPS)
    extend_roll_ups(first, lake, dict.fromkeys(r for name in names for r in REPORT_ROLL_UPS[name]))
    run_batch(events, Settings(lake=lake), new_days=rest, names=names)
    return lake


def _two_parts(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = F.col("timestamp") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return events.where(first), events.where(~first)


def _stored_report(report: str) -> Query:
    """A stored report, all columns."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = read_current(spark, f"{_lake(spark, sf_dir, report).batch}/{report}")
        return _rounded(df, *[c for c in ("avg_metric_value",) if c in df.columns])

    return query


def performance_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`performance_by_metric` from the quantile sketches of the days, added in two steps."""
    lake = LakeSettings(root=workspace(spark, "sketches"))
    for part in _two_parts(_devices(spark, sf_dir)):
        days = extend_roll_ups(part, lake, ["performance_days"])["performance_days"]
    return _rounded(sketches.performance_from_days(days, *SEGMENT, "metric_name"), "avg_metric_value")


def active_devices_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active devices of a range of days by region and device type, from the distinct sketches of the days."""
    lake = LakeSettings(root=workspace(spark, "sketches"))
    for part in _two_parts(_full(spark, sf_dir)):
        days = extend_roll_ups(part, lake, ["active_days"])["active_days"]
    return sketches.active_devices_range(days, *RANGE, by=["region", "device_type"])


def _bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = LakeSettings(root=workspace(spark, "bitmaps"))
    for part in _two_parts(_no_dims(spark, sf_dir)):
        words = extend_bitmaps(part.select("device_id", event_date().alias("date")), lake)
    return words


def batch_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports over stored roll-ups, written and read back: the rows and one total of each."""
    lake = _lake(spark, sf_dir)
    summaries = [
        read_current(spark, f"{lake.batch}/{report}").agg(
            F.lit(report).alias("report"),
            F.count("*").alias("row_count"),
            F.sum(total).cast("bigint").alias("total"),
        )
        for report, total in REPORT_TOTALS.items()
    ]
    return raw.union_topics(*summaries)


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "reports")
    sinks.write_reports({"regional_trends": usage.daily_trends_by_region(_regions(spark, sf_dir), ordered=False)}, path)
    return read_current(spark, f"{path}/regional_trends")


def publish_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "published")
    sinks.publish(_full(spark, sf_dir), path)
    body = F.from_json("value", event_schema(timestamp=T.StringType()))
    sent = spark.read.parquet(path).select("topic", "key", body.alias("v"))
    return sent.select("topic", "key", "v.event_id", "v.event_type", "v.region", "v.payload").select(
        "topic", "key", "event_id", "event_type", "region", *_payload()
    )


def archive_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    historical, active = workspace(spark, "historical"), workspace(spark, "active")
    trends = stored(usage.daily_trends_by_region(_regions(spark, sf_dir), ordered=False), "trends")
    sinks.archive(trends, AS_OF, historical, active, ARCHIVE_DAYS)
    old = spark.read.parquet(historical).drop("archived_before").withColumn("tier", F.lit("historical"))
    return old.unionByName(spark.read.parquet(active).withColumn("tier", F.lit("active")))


def archive_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored report archived on two days, with the report served in between and after."""
    lake = LakeSettings(root=workspace(spark, "archive-lake"), archive_after_days=ARCHIVE_DAYS)
    trends = usage.daily_trends_by_region(_regions(spark, sf_dir), ordered=False)
    sinks.write_reports({"regional_trends": trends}, lake.batch)
    for as_of in AS_OF_DATES:
        sinks.archive_report(spark, "regional_trends", as_of, lake)
    old = sinks.read_archive(spark, "regional_trends", lake)
    old = old.withColumn("tier", F.concat(F.lit("before "), F.col("archived_before"))).drop("archived_before")
    served = read_current(spark, f"{lake.batch}/regional_trends").withColumn("tier", F.lit("served"))
    return old.unionByName(served)


# --- expressions --------------------------------------------------------------


def expr_daily_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_dims(spark, sf_dir).where(is_type("app_open")).select(
        "event_id",
        event_date().alias("date"),
        F.when(F.col("payload.is_cold_start"), F.col("payload.session_id")).alias("cold_session_id"),
        F.col("payload.launch_time_ms").alias("launch_time_ms"),
    )


def expr_payload_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload as the wire's map of text, looked up by key."""
    messages = wire.encode(_no_dims(spark, sf_dir))
    return wire.decode(messages).where(is_type("feature_used")).select(
        "event_id",
        F.col("payload")["feature_name"].alias("feature_name"),
        F.col("payload")["interaction_count"].try_cast("bigint").alias("interaction_count"),
    )


def expr_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.datediff(event_date(), F.lit("2024-01-01").cast("date"))
    return _no_dims(spark, sf_dir).where(is_type("crash_event")).select(
        "event_id",
        F.when(is_fatal(), 1).otherwise(0).alias("fatal"),
        bucket_start(since, 7).alias("week_start_day"),
    )


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event to JSON text, back, and to text again; ``stable`` says both texts are equal."""
    first = wire.encode(_full(spark, sf_dir)).select(F.col("value").alias("first"))
    # the wire form: timestamp as text, payload typed
    record = F.from_json("first", event_schema(timestamp=T.StringType()))
    back = first.select("first", F.inline(F.array(record)))
    again = F.to_json(F.struct(*[F.col(c) for c in back.columns if c != "first"]))
    return back.select(
        "event_id", "event_type", F.col("timestamp").cast("timestamp_ntz").alias("event_time"), "region",
        "payload.session_id", "payload.duration_ms", "payload.is_fatal",
        F.col("payload.value").alias("metric_value"),
        (again == F.col("first")).alias("stable"),
    )


def _open_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as messages with its own event types, landed whole and read back."""
    path = workspace(spark, "open")
    facts = table(spark, sf_dir, "events")
    record = F.struct(
        F.col("event_id").cast("string").alias("event_id"), "event_type", F.date_format("ts", wire.TIMESTAMP_FORMAT).alias("timestamp"),
        F.col("user_id").cast("string").alias("device_id"),
        # fields that the schema of events has no column for
        F.struct(F.lit(2).alias("major"), F.array(F.lit("a"), F.col("event_type")).alias("tags")).alias("client"),
        F.struct("value", F.try_parse_json("props").alias("props")).alias("payload"),
    )
    open_payload.land_open(facts.select(F.to_json(record).alias("value")), path)
    return open_payload.load_open(spark, path)


def open_payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns and fields outside the schema, out of landed records."""
    field = open_payload.open_field
    return _open_events(spark, sf_dir).select(
        "event_id", "event_type", F.col("timestamp").cast("timestamp_ntz").alias("event_time"), "device_id", "topic",
        F.col("payload.value").alias("metric_value"), field("payload.props.k", "int").alias("k"),
        field("client.major", "int").alias("client_major"), field("client.tags[1]").alias("client_tag"),
    )


def open_field_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the landed records; whether a decimal or a double is written for a number depends on the number."""
    report = open_payload.field_report(_open_events(spark, sf_dir))
    return report.where(~F.col("value_type").isin("DECIMAL", "DOUBLE", "BIGINT")).drop("value_type").unionByName(
        report.where(F.col("value_type").isin("DECIMAL", "DOUBLE", "BIGINT"))
        .groupBy("event_type", "part", "field", "known").agg(F.sum("n_events").alias("n_events"))
    )


# --- lookups and tables by device -------------------------------------------------


def _lookup_landing(spark: SparkSession, sf_dir: str) -> str:
    path = workspace(spark, "lookup")
    sinks.land_raw(_full(spark, sf_dir), path, lookup=LOOKUP)
    return path


def lookup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_naive(lookup.find_events(spark, _lookup_landing(spark, sf_dir), EVENT_IDS), "timestamp"))


def lookup_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.find_events(spark, _lookup_landing(spark, sf_dir), device_ids=DEVICE_IDS, date=DAY)
    return _flat(_naive(found, "timestamp"))


def _by_device(spark: SparkSession, sf_dir: str) -> LakeSettings:
    """The tables by device, added to in two steps."""
    lake = LakeSettings(root=workspace(spark, "lake"), database=f"telemetry_{uuid.uuid4().hex}", device_buckets=DEVICE_BUCKETS)
    for part in _two_parts(_full(spark, sf_dir)):
        extend_roll_ups(part, lake, device_tables.DEVICE_TABLES)
        days = [r[0] for r in part.select(event_date().alias("date")).distinct().collect()]
        device_tables.extend_device_tables(spark, lake, days)
    return lake


def retention_by_device_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = device_tables.device_table(spark, "device_days", _by_device(spark, sf_dir))
    return retention.rates_from_cohorts(retention.cohorts_from_activity(days))


def crashes_by_device_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crashes.crashes_from_activity(device_tables.device_table(spark, "device_days", _by_device(spark, sf_dir)))


def features_of_crashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_tables.features_of_crashed(spark, _by_device(spark, sf_dir))


# --- batch reports --------------------------------------------------------------


def device_performance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(performance.device_performance_report(_devices(spark, sf_dir)), "avg_metric_value")


def performance_by_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(performance.performance_by_metric(_devices(spark, sf_dir)), "avg_metric_value")


def union_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three topics, each with the payload fields it has, as one table again."""
    events = quality.with_topic(_no_dims(spark, sf_dir))
    fields = {
        "app_events": ("session_id", "feature_name", "duration_ms"),
        "crashes": ("crash_type", "is_fatal"),
        "performance": ("metric_name", "value"),
    }
    topics = [
        events.where(F.col("topic") == topic).select(
            "event_id", "event_type", "topic", F.struct(*[F.col(f"payload.{n}") for n in names]).alias("payload")
        )
        for topic, names in fields.items()
    ]
    every = [name for names in fields.values() for name in names]
    return raw.union_topics(*topics).select(
        "event_id", "event_type", "topic", *[F.col(f"payload.{name}").alias(name) for name in every]
    )


def topk_crash_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crashes.top_crash_segments(crashes.crash_analysis(_devices(spark, sf_dir), ordered=False), 5)


# --- serving --------------------------------------------------------------------


def serve_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.usage(usage.daily_usage_trends(_no_dims(spark, sf_dir), ordered=False), *RANGE)


def serve_usage_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.usage_from_events(_full(spark, sf_dir), REGION, "mobile", *RANGE)


def serve_usage_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.usage_from_events(_regions(spark, sf_dir), REGION, None, *RANGE, granularity="hourly")


def serve_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.crashes(crashes.crash_analysis(_devices(spark, sf_dir), ordered=False), os="Android")


def serve_adoption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.adoption(features.feature_ranking(_no_dims(spark, sf_dir), ordered=False), top_n=5)


def serve_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = performance.device_performance_report(_devices(spark, sf_dir), ordered=False)
    return serving.performance(_rounded(report, "avg_metric_value"), device_type="mobile")


def _sql_function(call: str, *reports: str) -> Query:
    """A serving function of the lake's database, called in SQL over the stored reports."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = replace(_lake(spark, sf_dir, *reports), database=f"telemetry_{uuid.uuid4().hex}")
        catalog.register_reports(spark, lake, reports)
        df = catalog.sql_session(spark, lake.database).sql(f"SELECT * FROM {call}")
        return _rounded(df, *[c for c in ("avg_metric_value",) if c in df.columns])

    return query


def sql_usage_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`serve_usage_filtered` in SQL, over the landed events."""
    lake = LakeSettings(root=workspace(spark, "lake"), database=f"telemetry_{uuid.uuid4().hex}")
    sinks.land_raw(_full(spark, sf_dir), lake.raw)
    catalog.register_lake(spark, lake)
    start, end = RANGE
    return catalog.sql_session(spark, lake.database).sql(
        f"SELECT * FROM usage_metrics_by('{REGION}', 'mobile', start_date => DATE '{start}', end_date => DATE '{end}')"
    )


def realtime_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.realtime_snapshot(_no_dims(spark, sf_dir))


def snapshot_from_speed_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest minute that the speed layer has stored."""
    _, events = _event_stream(spark, sf_dir, windows=True, together=True)
    events = wire.with_event_time(events, StreamSettings().watermark)
    output, checkpoints = workspace(spark, "metrics"), workspace(spark, "metrics-checkpoints")
    for query in jobs.start_speed_layer(events, events, output, checkpoints, available_now=True):
        jobs.run_to_end(query)
    snapshot = serving.MetricsStore(spark, output, metrics_path=output).get_realtime_snapshot()
    return _naive(snapshot, "snapshot_time")


def bi_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _no_dims(spark, sf_dir)
    return catalog.top_features(spark, features.feature_ranking(events, ordered=False), usage.distinct_devices(events))


def bi_crash_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.crash_rates(spark, crashes.crash_analysis(_devices(spark, sf_dir), ordered=False))


def bi_region_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.region_usage(spark, usage.daily_trends_by_region(_regions(spark, sf_dir), ordered=False), REGION)


def bi_week_over_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.week_over_week(spark, usage.daily_usage_trends(_no_dims(spark, sf_dir), ordered=False))


# --- observability ----------------------------------------------------------------


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performance samples, their value taken as milliseconds."""
    return _no_dims(spark, sf_dir).where(is_type("performance_metric")).select(
        "timestamp",
        F.col("payload.metric_name").alias("metric_name"),
        (F.col("payload.value") / 1000).alias("seconds"),
    )


def histogram_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.histogram_buckets(_samples(spark, sf_dir), ["metric_name"], F.col("seconds"))


def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    estimates = observe.histogram_quantile(
        _samples(spark, sf_dir),
        [F.window("timestamp", "5 minutes").alias("w")],
        F.col("seconds"),
        {"p50": 0.5, "p95": 0.95},
    )
    return _rounded(estimates.select(F.col("w.start").alias("window_start"), "p50", "p95"), "p50", "p95")


def latency_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    uses = _no_dims(spark, sf_dir).where(is_type("feature_used")).select(
        event_date().alias("date"),
        F.col("payload.feature_name").alias("feature_name"),
        F.col("payload.duration_ms").cast("double").alias("ms"),
    )
    return observe.latency_alerts(uses, ["date", "feature_name"], F.col("ms"), AlertSettings().max_latency_ms)


def run_latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.run_latency_summary(
        _no_dims(spark, sf_dir), "app_version", F.col("payload.duration_ms").cast("double"), is_type("crash_event")
    )


# --- quality ------------------------------------------------------------------------


def dq_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _careless(spark, sf_dir).select("event_id", quality.envelope_reason().alias("reason"))


def _careless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with faults that follow from the data: clicks keep their own event type, customers
    of HOUSEHOLD their segment as device type, and the device or region is lost for some ``k``."""
    facts = table(spark, sf_dir, "events").withColumn("k", F.expr(K))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    kind = F.col("event_type")
    return facts.join(customer, F.col("user_id") == F.col("c_custkey"), "left").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(kind == "signup", "app_open")
        .when(kind == "error", "crash_event")
        .when(kind == "purchase", "performance_metric")
        .when(kind == "view", "feature_used")
        .otherwise(kind)
        .alias("event_type"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("k") % 25 != 0, F.col("user_id").cast("string")).alias("device_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "household").otherwise("mobile").alias("device_type"),
        F.lit("iOS").alias("os"),
        F.lit("2.4.1").alias("app_version"),
        F.when(F.col("k") % 25 != 1, "us-east").alias("region"),
        "k",
        "value",
    )


def dq_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices whose clock is lost, at its start, or far ahead, for some ``k``."""
    k = F.col("k")
    clock = F.when(k % 25 == 1, F.lit("1970-01-01T00:00:07")).when(k % 25 == 2, F.lit("9999-12-31T23:59:59")).cast("timestamp_ntz")
    events = _careless(spark, sf_dir).withColumn("timestamp", F.when(k % 25 != 0, F.coalesce(clock, F.col("timestamp"))))
    return observe.implausible_clocks(events)


def dq_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map payloads of which some ``k`` lack a field or hold text that is no number."""
    k = F.col("k")
    payload = F.create_map(
        F.lit("session_id"), F.when(k % 11 != 3, F.concat(F.lit("s"), k.cast("string"))),
        F.lit("launch_time_ms"), F.when(k % 7 == 2, "slow").otherwise(k.cast("string")),
        F.lit("is_cold_start"), F.when(k % 3 == 0, "true").otherwise("false"),
        F.lit("feature_name"), F.concat(F.lit("feature_"), k.cast("string")),
        F.lit("duration_ms"), F.when(k % 13 != 5, k.cast("string")),
        F.lit("interaction_count"), F.when(k % 17 == 4, "many").otherwise(k.cast("string")),
        F.lit("crash_type"), F.lit("crash"),
        F.lit("stack_trace"), F.lit("at top"),
        F.lit("is_fatal"), F.when(k % 5 == 0, "maybe").otherwise("false"),
        F.lit("memory_usage_mb"), F.when(k % 19 == 6, "").otherwise(k.cast("string")),
        F.lit("metric_name"), F.lit("metric"),
        F.lit("value"), F.when(k % 2 == 0, F.concat(k.cast("string"), F.lit(".5"))),
        F.lit("unit"), F.lit("ms"),
    )
    return _careless(spark, sf_dir).select(
        "event_id", "event_type", payload.alias("payload")
    ).select("event_id", "event_type", quality.payload_reason().alias("reason"))


def dq_os_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OS by event number whatever the device, so that some do not fit."""
    systems = F.array(*[F.lit(s) for s in ("iOS", "Android", "Windows", "macOS", "Linux")])
    slot = F.pmod(F.col("event_id").cast("bigint"), F.lit(5)).cast("int")
    return quality.os_device_check(_devices(spark, sf_dir).withColumn("os", systems[slot]))


def dq_event_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.event_mix(_no_dims(spark, sf_dir)), "drift")


def dq_region_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.region_coverage(_regions(spark, sf_dir), EXPECTED_REGIONS)


def _faulty_messages(events: DataFrame) -> DataFrame:
    """Messages keyed by event id, of which some are cut short or are no object."""
    n = F.col("key").cast("bigint")
    return wire.encode(events.withColumn("device_id", F.col("event_id"))).withColumn(
        "value",
        F.when(n % 10 == 7, F.substring("value", 1, 20)).when(n % 10 == 3, "[1, 2]").otherwise(F.col("value")),
    )


def dq_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire.parse(_faulty_messages(_no_dims(spark, sf_dir)), "key").select("key", "malformed")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of messages, checked and landed by status. The tables give no stack trace or unit,
    which the payload rules ask for, so crashes and samples are quarantined too."""
    _, events = _event_stream(spark, sf_dir)
    checked = quality.check_messages(_faulty_messages(events), "key")
    path, checkpoint = workspace(spark, "checked"), workspace(spark, "checked-checkpoint")
    jobs.run_to_end(jobs.land_checked_stream(checked, path, checkpoint, trigger=None))
    return spark.read.parquet(path).select("key", "event_type", "status", "reason")


def route_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_topic(_no_dims(spark, sf_dir)).select("event_id", "event_type", "topic")


def reconcile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _no_dims(spark, sf_dir).select("event_id", "event_type", "payload.is_fatal")
    return quality.reconcile_ids(*_two_sides(events))


def _over(source: Query, operator: Callable[..., DataFrame], *args: object, **kwargs: object) -> Query:
    """The operator over a view of the tables."""
    return lambda spark, sf_dir: operator(source(spark, sf_dir), *args, **kwargs)


QUERIES: dict[str, Query] = {
    # sources and sinks
    "src_decode_json": src_decode_json,
    "src_raw_events": src_raw_events,
    "scan_by_date": scan_by_date,
    "table_raw_by_topic": table_raw_by_topic,
    "stream_all_topics": stream_all_topics,
    "stream_dedup": stream_dedup,
    "stream_reconcile": stream_reconcile,
    "sink_stream_parquet": _closed_windows("error_spikes"),
    "stream_active_users": _closed_windows("active_users"),
    "stream_feature_usage": _closed_windows("feature_usage"),
    "repair_late_windows": repair_late_windows,
    "batch_layer": batch_layer,
    **{f"stored_{report}": _stored_report(report) for report in REPORT_TOTALS},
    "performance_from_sketches": performance_from_sketches,
    "active_devices_range": active_devices_range,
    "retention_from_bitmaps": _over(_bitmaps, device_bitmaps.retention_from_bitmaps),
    "device_lifecycle": _over(_bitmaps, device_bitmaps.lifecycle, LIFECYCLE_DAY),
    "pipeline_end_to_end": pipeline_end_to_end,
    "sink_roundtrip": sink_roundtrip,
    "publish_keyed": publish_keyed,
    "raw_landing": raw_landing,
    "archive_split": archive_split,
    "archive_two_runs": archive_two_runs,
    # expressions
    "expr_daily_projection": expr_daily_projection,
    "expr_payload_lookup": expr_payload_lookup,
    "expr_conditional": expr_conditional,
    "json_roundtrip": json_roundtrip,
    "open_payload_roundtrip": open_payload_roundtrip,
    "open_field_report": open_field_report,
    "lookup_events": lookup_events,
    "lookup_devices": lookup_devices,
    "retention_by_device_table": retention_by_device_table,
    "crashes_by_device_table": crashes_by_device_table,
    "features_of_crashed": features_of_crashed,
    # batch reports
    "daily_usage_trends": _over(_no_dims, usage.daily_usage_trends),
    "daily_trends_by_region": _over(_regions, usage.daily_trends_by_region),
    "feature_adoption_rates": _over(_no_dims, features.feature_adoption_rates),
    "feature_ranking": _over(_no_dims, features.feature_ranking),
    "device_first_seen": _over(_no_dims, retention.device_first_seen),
    "retention_cohorts": _over(_no_dims, retention.retention_cohorts),
    "retention_rates": _over(_no_dims, retention.retention_rates),
    "device_performance_report": device_performance_report,
    "performance_by_metric": performance_by_metric,
    "segment_population": _over(_devices, crashes.segment_population),
    "crash_analysis": _over(_devices, crashes.crash_analysis),
    "distinct_devices": _over(_no_dims, usage.distinct_devices),
    "union_topics": union_topics,
    "topk_crash_segments": topk_crash_segments,
    # event-time windows
    "tumbling_minute_counts": _over(_no_dims, windows.tumbling_counts, "1 minute"),
    "tumbling_30s_counts": _over(_no_dims, windows.tumbling_counts, "30 seconds"),
    "active_users_per_minute": _over(_full, windows.active_users_per_minute),
    "error_spikes": _over(_devices, windows.error_spikes),
    "feature_usage_per_minute": _over(_no_dims, windows.feature_usage),
    "spike_alerts": _over(_devices, windows.spike_alerts, 0.05),
    # serving and BI
    "serve_usage": serve_usage,
    "serve_usage_filtered": serve_usage_filtered,
    "serve_usage_hourly": serve_usage_hourly,
    "serve_crashes": serve_crashes,
    "serve_adoption": serve_adoption,
    "serve_performance": serve_performance,
    "sql_usage": _sql_function(f"usage_metrics(DATE '{RANGE[0]}', DATE '{RANGE[1]}')", "daily_trends"),
    "sql_usage_by": sql_usage_by,
    "sql_crashes": _sql_function("crash_metrics(in_os => 'Android')", "crash_analysis"),
    "sql_adoption": _sql_function("adoption_metrics(top_n => 5)", "feature_ranking"),
    "sql_performance": _sql_function(
        "performance_metrics('mobile', in_metric_name => 'metric_1')", "device_performance", "performance_by_metric"
    ),
    "realtime_snapshot": realtime_snapshot,
    "snapshot_from_speed_layer": snapshot_from_speed_layer,
    "bi_top_features": bi_top_features,
    "bi_crash_rates": bi_crash_rates,
    "bi_region_usage": bi_region_usage,
    "bi_week_over_week": bi_week_over_week,
    # observability
    "event_rate_per_minute": _over(_no_dims, observe.event_rate),
    "throughput_status": _over(_no_dims, observe.throughput_status, THROUGHPUT_STEPS, LOW_THROUGHPUT),
    "error_rate_5m": _over(_no_dims, observe.error_rate, ERROR_STEPS),
    "histogram_buckets": histogram_buckets,
    "histogram_quantile": histogram_quantile,
    "events_by_topic": _over(_no_dims, observe.events_by_topic),
    "latency_alerts": latency_alerts,
    "run_latency_summary": run_latency_summary,
    # quality and routing
    "dq_envelope": dq_envelope,
    "dq_clocks": dq_clocks,
    "dq_payload": dq_payload,
    "dq_os_device": dq_os_device,
    "dq_event_mix": dq_event_mix,
    "dq_region_coverage": dq_region_coverage,
    "dq_malformed": dq_malformed,
    "stream_quarantine": stream_quarantine,
    "route_topic": route_topic,
    "reconcile_ids": reconcile_ids,
}
