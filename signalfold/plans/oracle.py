"""The registered queries as DuckDB SQL over the same tables: an independent statement of each."""

from __future__ import annotations

TELEMETRY = """with b as (
  select e.event_id, e.ts, e.user_id, e.event_type, e.value,
         cast(json_extract_string(e.props, '$.k') as int) as k, c.c_mktsegment as seg, r.r_name as region
  from events e
  left join customer c on c.c_custkey = e.user_id
  left join nation n on n.n_nationkey = c.c_nationkey
  left join region r on r.r_regionkey = n.n_regionkey
), t as (
  select *, case event_type when 'signup' then 'app_open' when 'error' then 'crash_event'
                 when 'purchase' then 'performance_metric' else 'feature_used' end as et,
         case when seg in ('AUTOMOBILE', 'MACHINERY') then 'mobile'
              when seg in ('BUILDING', 'FURNITURE') then 'desktop' else 'tablet' end as dt
  from b
), telemetry as (
  select cast(event_id as varchar) as event_id, et as event_type, ts as event_time,
    cast(user_id as varchar) as device_id, dt as device_type,
    case when dt <> 'desktop' then case when k % 2 = 0 then 'iOS' else 'Android' end
         when k % 3 = 0 then 'Windows' when k % 3 = 1 then 'macOS' else 'Linux' end as os,
    case user_id % 4 when 0 then '2.3.0' when 1 then '2.4.0' when 2 then '2.4.1' else '2.5.0-beta' end as app_version,
    region,
    case when et = 'app_open' then concat(cast(user_id as varchar), '-', cast(cast(ts as date) as varchar)) end as session_id,
    case when et = 'app_open' then cast(k * 80 as bigint) end as launch_time_ms,
    case when et = 'app_open' then k % 10 < 3 end as is_cold_start,
    case when et = 'feature_used' then concat('feature_', cast(k % 15 as varchar)) end as feature_name,
    case when et = 'feature_used' then cast(round(value * 100) as bigint) end as duration_ms,
    case when et = 'feature_used' then cast(k % 50 + 1 as bigint) end as interaction_count,
    case when et = 'crash_event' then concat('crash_', cast(k % 8 as varchar)) end as crash_type,
    case when et = 'crash_event' then k % 5 = 0 end as is_fatal,
    case when et = 'crash_event' then 100 + value end as memory_usage_mb,
    case when et = 'performance_metric' then concat('metric_', cast(k % 7 as varchar)) end as metric_name,
    case when et = 'performance_metric' then value end as metric_value,
    cast(ts as date) as date,
    case et when 'crash_event' then 'crashes' when 'performance_metric' then 'performance' else 'app_events' end as topic
  from t
)"""

FLAT = """select event_id, event_type, event_time, device_id, device_type, os, app_version, region, session_id,
  launch_time_ms, is_cold_start, feature_name, duration_ms, interaction_count, crash_type, is_fatal,
  memory_usage_mb, metric_name, metric_value as value from telemetry"""

PAYLOAD = """session_id, launch_time_ms, is_cold_start, feature_name, duration_ms, interaction_count, crash_type,
  is_fatal, memory_usage_mb, metric_name, metric_value as value"""

DAILY = """select date, count(distinct device_id) as daily_active_users, count(*) as total_events,
  count(distinct case when event_type = 'app_open' then session_id end) as total_sessions
  from telemetry{where} group by date"""

REGIONAL = """select date, region, count(distinct device_id) as daily_active_users, count(*) as total_events
  from telemetry group by date, region"""

FEATURE_TOTALS = """select feature_name, count(distinct device_id) as unique_users, count(*) as total_usage,
  avg(duration_ms) as avg_duration_ms, avg(interaction_count) as avg_interactions
  from telemetry where event_type = 'feature_used' group by feature_name"""

RANKED = f"""select *, cast(row_number() over (order by unique_users desc, total_usage desc, feature_name) as int) as rank
  from ({FEATURE_TOTALS})"""

FIRST_SEEN = "select device_id, min(date) as first_seen from telemetry group by device_id"

COHORTS = f"""select f.first_seen, cast((date_diff('day', f.first_seen, t.date) // 7) * 7 as int) as cohort_bucket,
  count(distinct t.device_id) as retained_users
  from telemetry t join ({FIRST_SEEN}) f on t.device_id = f.device_id group by 1, 2"""

RETENTION = f"""select c.*, s.cohort_size, c.retained_users / s.cohort_size as retention_rate from ({COHORTS}) c
  join (select first_seen, count(*) as cohort_size from ({FIRST_SEEN}) group by 1) s using (first_seen)"""

PERFORMANCE = """select {keys}, round(avg(metric_value), 6) as avg_metric_value, quantile_disc(metric_value, 0.5) as p50,
  quantile_disc(metric_value, 0.95) as p95, quantile_disc(metric_value, 0.99) as p99, count(*) as sample_count
  from telemetry where event_type = 'performance_metric' group by {keys}"""
SEGMENT = "device_type, os, app_version"

POPULATION = f"select {SEGMENT}, count(distinct device_id) as total_devices from telemetry group by {SEGMENT}"

CRASHES = f"""select c.*, p.total_devices, c.affected_devices / p.total_devices as crash_rate
  from (select {SEGMENT}, count(*) as crash_count, count(distinct device_id) as affected_devices,
          cast(sum(case when is_fatal then 1 else 0 end) as bigint) as fatal_crashes
        from telemetry where event_type = 'crash_event' group by {SEGMENT}) c
  left join ({POPULATION}) p using (device_type, os, app_version)"""

WINDOW = (
    "time_bucket(interval '{0}', event_time) as window_start, "
    "time_bucket(interval '{0}', event_time) + interval '{0}' as window_end"
)
MINUTE, HALF_MINUTE = WINDOW.format("1 minute"), WINDOW.format("30 seconds")

ERROR_SPIKES = f"""select {HALF_MINUTE}, os, app_version, count(*) as crash_count,
  count(distinct device_id) as affected_devices
  from telemetry where event_type = 'crash_event' group by 1, 2, os, app_version"""

ACTIVE_USERS = f"""select {MINUTE}, region, device_type, count(distinct device_id) as active_users,
  count(*) as event_count from telemetry group by 1, 2, region, device_type"""

FEATURE_USAGE = f"""select {MINUTE}, feature_name, count(*) as usage_count, count(distinct device_id) as unique_users
  from telemetry where event_type = 'feature_used' group by 1, 2, feature_name"""

ADOPTION = """select date, feature_name, count(distinct device_id) as unique_users, count(*) as total_usage,
  avg(duration_ms) as avg_duration_ms,
  count(distinct device_id) / (select count(*) from (select distinct device_id from telemetry)) as adoption_rate
  from telemetry where event_type = 'feature_used' group by date, feature_name"""

USAGE_RANGE = " where date between date '2024-01-05' and date '2024-01-20'"

SECONDS = "metric_value / 1000"
BOUNDS = "(values (1, '0.001', 0.001::double), (2, '0.005', 0.005::double), (3, '0.01', 0.01::double), " \
    "(4, '0.025', 0.025::double), (5, '0.05', 0.05::double), (6, '0.1', 0.1::double), (7, '0.25', 0.25::double), " \
    "(8, '+Inf', 'inf'::double)) bounds(i, le, bound)"

ARCHIVED = f"""select *, case when date < date '2024-01-31' - 15 then 'historical' else 'active' end as tier
  from ({REGIONAL})"""

# envelopes with the faults of the registry's careless client
CARELESS = """with c as (
  select cast(e.event_id as varchar) as event_id, cast(json_extract_string(e.props, '$.k') as int) as k,
    e.event_type as own, c.c_mktsegment as seg
  from events e left join customer c on c.c_custkey = e.user_id
)"""

PAYLOAD_REASON = CARELESS + """
select event_id, case own when 'signup' then 'app_open' when 'error' then 'crash_event'
    when 'purchase' then 'performance_metric' when 'view' then 'feature_used' else own end as event_type,
  nullif(concat_ws(',',
    case when own = 'signup' and k % 11 = 3 then 'missing:session_id' end,
    case when own = 'signup' and k % 7 = 2 then 'invalid:launch_time_ms' end,
    case when own = 'view' and k % 13 = 5 then 'missing:duration_ms' end,
    case when own = 'view' and k % 17 = 4 then 'invalid:interaction_count' end,
    case when own = 'error' and k % 5 = 0 then 'invalid:is_fatal' end,
    case when own = 'error' and k % 19 = 6 then 'invalid:memory_usage_mb' end,
    case when own = 'purchase' and k % 2 = 1 then 'missing:value' end), '') as reason
from c"""

ENVELOPE_REASON = CARELESS + """
select event_id, nullif(concat_ws(',',
    case when k % 25 = 0 then 'missing:device_id' end,
    case when k % 25 = 1 then 'missing:region' end,
    case when own = 'click' then 'invalid:event_type' end,
    case when seg = 'HOUSEHOLD' then 'invalid:device_type' end), '') as reason
from c"""


def _t(select: str) -> str:
    return f"{TELEMETRY}\n{select}"


def _series(width: str) -> str:
    """All windows from the first to the last event, as ``window_start``."""
    ends = f"time_bucket(interval '{width}', min(event_time)), time_bucket(interval '{width}', max(event_time)), interval '{width}'"
    return f"(select unnest(generate_series({ends})) as window_start from telemetry) series"


def _closed(windows: str) -> str:
    """Windows that end 10 seconds or more before the newest event, with their day."""
    return _t(
        f"select *, cast(window_start as date) as window_date from ({windows}) "
        "where window_end <= (select max(event_time) from telemetry) - interval '10 seconds'"
    )


ORACLE: dict[str, str] = {
    # sources and sinks
    "src_decode_json": _t(FLAT),
    "src_raw_events": _t(FLAT),
    "scan_by_date": _t(
        "select event_id, event_type, event_time, device_id from telemetry where date = date '2024-01-10'"
    ),
    "table_raw_by_topic": _t(
        "select concat('raw_', topic) as table_name, event_type, count(*) as event_count from telemetry group by 1, 2"
    ),
    "stream_all_topics": _t(
        "select topic, event_type, date as event_date, count(*) as event_count, count(distinct device_id) as devices "
        "from telemetry group by 1, 2, 3"
    ),
    "sink_stream_parquet": _closed(ERROR_SPIKES),
    "stream_active_users": _closed(ACTIVE_USERS),
    "stream_feature_usage": _closed(FEATURE_USAGE),
    # all rows, in the windows that the stream has closed by the rows that come in time
    "repair_late_windows": _t(
        f"select * from ({ACTIVE_USERS}) where window_end <= (select max(e) from ("
        "select time_bucket(interval '1 minute', event_time) + interval '1 minute' as e from telemetry where event_id::bigint % 10 <> 3) "
        "where e <= (select max(event_time) from telemetry where event_id::bigint % 10 <> 3) - interval '10 seconds')"
    ),
    "batch_layer": _t(
        " union all ".join(
            f"select '{report}' as report, count(*) as row_count, cast(sum({total}) as bigint) as total from ({sql})"
            for report, total, sql in (
                ("daily_trends", "total_sessions", DAILY.format(where="")),
                ("regional_trends", "daily_active_users", REGIONAL),
                ("feature_adoption", "unique_users", ADOPTION),
                ("feature_ranking", "rank", RANKED),
                ("retention_cohorts", "retained_users", COHORTS),
                ("device_performance", "sample_count", PERFORMANCE.format(keys=SEGMENT)),
                ("performance_by_metric", "sample_count", PERFORMANCE.format(keys=f"{SEGMENT}, metric_name")),
                ("crash_analysis", "affected_devices", CRASHES),
            )
        )
    ),
    "sink_roundtrip": _t(REGIONAL),
    "publish_keyed": _t(f"select topic, device_id as key, event_id, event_type, region, {PAYLOAD} from telemetry"),
    "raw_landing": _t(f"select event_id, topic, date as event_date, event_type, device_id, region, {PAYLOAD} from telemetry"),
    "archive_split": _t(ARCHIVED),
    "archive_two_runs": _t(
        "select *, case when date < date '2024-01-11' then 'before 2024-01-11' "
        f"when date < date '2024-01-16' then 'before 2024-01-16' else 'served' end as tier from ({REGIONAL})"
    ),
    "stored_daily_trends": _t(DAILY.format(where="")),
    "stored_regional_trends": _t(REGIONAL),
    "stored_feature_adoption": _t(ADOPTION),
    "stored_feature_ranking": _t(RANKED),
    "stored_retention_cohorts": _t(COHORTS),
    "stored_device_performance": _t(PERFORMANCE.format(keys=SEGMENT)),
    "stored_performance_by_metric": _t(PERFORMANCE.format(keys=f"{SEGMENT}, metric_name")),
    "stored_crash_analysis": _t(CRASHES),
    "pipeline_end_to_end": _t(
        "select date, null::varchar as feature_name, count(distinct device_id) as users, count(*) as events, "
        "count(distinct session_id) as total_sessions from telemetry where event_id::bigint % 10 not in (7, 9) group by date "
        "union all select date, feature_name, count(distinct device_id), count(*), null from telemetry "
        "where event_id::bigint % 10 not in (7, 9) and event_type = 'feature_used' group by date, feature_name"
    ),
    # expressions
    "expr_daily_projection": _t(
        "select event_id, date, case when is_cold_start then session_id end as cold_session_id, launch_time_ms "
        "from telemetry where event_type = 'app_open'"
    ),
    "expr_payload_lookup": _t(
        "select event_id, feature_name, interaction_count from telemetry where event_type = 'feature_used'"
    ),
    "expr_conditional": _t(
        "select event_id, cast(case when is_fatal then 1 else 0 end as int) as fatal, "
        "cast((date_diff('day', date '2024-01-01', date) // 7) * 7 as int) as week_start_day "
        "from telemetry where event_type = 'crash_event'"
    ),
    "json_roundtrip": _t(
        "select event_id, event_type, event_time, region, session_id, duration_ms, is_fatal, metric_value, "
        "true as stable from telemetry"
    ),
    "open_payload_roundtrip": """select cast(event_id as varchar) as event_id, event_type, ts as event_time,
  cast(user_id as varchar) as device_id, 'app_events' as topic, value as metric_value,
  cast(json_extract_string(props, '$.k') as int) as k, cast(2 as int) as client_major, event_type as client_tag from events""",
    "open_field_report": """select event_type, f.part, f.field, f.known, count(*) as n_events from events cross join
  (values ('envelope', 'event_id', true), ('envelope', 'event_type', true), ('envelope', 'timestamp', true),
    ('envelope', 'device_id', true), ('envelope', 'client', false), ('payload', 'value', false), ('payload', 'props', false)
  ) f(part, field, known) where f.field <> 'value' or value is not null group by all""",
    "lookup_events": _t(f"{FLAT} where cast(event_id as bigint) % 97 = 0 and cast(event_id as bigint) < 9700"),
    "lookup_devices": _t(
        f"{FLAT} where date = date '2024-01-10' and cast(device_id as bigint) % 7 = 0 and cast(device_id as bigint) < 140"
    ),
    "retention_by_device_table": _t(RETENTION),
    "crashes_by_device_table": _t(CRASHES),
    "features_of_crashed": _t(
        "select f.feature_name, count(*) as users, count(*) filter (where f.device_id in "
        "(select device_id from telemetry where event_type = 'crash_event')) as crashed_users from "
        "(select distinct feature_name, device_id from telemetry where event_type = 'feature_used') f group by f.feature_name"
    ),
    # batch reports
    "daily_usage_trends": _t(DAILY.format(where="")),
    "daily_trends_by_region": _t(REGIONAL),
    "feature_adoption_rates": _t(ADOPTION),
    "feature_ranking": _t(RANKED),
    "device_first_seen": _t(FIRST_SEEN),
    "retention_cohorts": _t(COHORTS),
    "retention_rates": _t(RETENTION),
    "retention_from_bitmaps": _t(RETENTION),
    "device_lifecycle": _t(
        "select state, count(now) as devices from (values ('new'), ('retained'), ('returning'), ('lost'), ('gone')) s(state) left join ("
        "select case when now then case when before then 'retained' when earlier then 'returning' else 'new' end "
        "when before then 'lost' else 'gone' end as state, now from (select device_id, "
        "bool_or(date between date '2024-01-14' and date '2024-01-20') as now, bool_or(date between date '2024-01-07' and date '2024-01-13') as before, "
        "bool_or(date < date '2024-01-07') as earlier from telemetry where date <= date '2024-01-20' group by device_id)) using (state) group by state"
    ),
    "performance_from_sketches": _t(PERFORMANCE.format(keys=f"{SEGMENT}, metric_name")),
    "active_devices_range": _t(
        "select region, device_type, count(distinct device_id) as active_devices, count(*) as events from telemetry "
        "where date between date '2024-01-05' and date '2024-01-20' group by region, device_type"
    ),
    "device_performance_report": _t(PERFORMANCE.format(keys=SEGMENT)),
    "performance_by_metric": _t(PERFORMANCE.format(keys=f"{SEGMENT}, metric_name")),
    "segment_population": _t(POPULATION),
    "crash_analysis": _t(CRASHES),
    "distinct_devices": _t("select distinct device_id from telemetry"),
    "union_topics": _t(
        "select event_id, event_type, topic, session_id, feature_name, duration_ms, crash_type, is_fatal, "
        "metric_name, metric_value as value from telemetry"
    ),
    "topk_crash_segments": _t(f"{CRASHES} order by crash_count desc, {SEGMENT} limit 5"),
    # event-time windows
    "tumbling_minute_counts": _t(f"select {MINUTE}, count(*) as event_count from telemetry group by 1, 2"),
    "tumbling_30s_counts": _t(f"select {HALF_MINUTE}, count(*) as event_count from telemetry group by 1, 2"),
    "active_users_per_minute": _t(ACTIVE_USERS),
    "error_spikes": _t(ERROR_SPIKES),
    "feature_usage_per_minute": _t(FEATURE_USAGE),
    "spike_alerts": _t(
        f"select *, crash_count / event_count as error_rate, crash_count / event_count > 0.05 as is_spike from ("
        f"select {HALF_MINUTE}, os, app_version, count(*) filter (event_type = 'crash_event') as crash_count, "
        "count(distinct device_id) filter (event_type = 'crash_event') as affected_devices, count(*) as event_count "
        "from telemetry group by 1, 2, os, app_version) where crash_count > 0"
    ),
    # serving and BI
    "serve_usage": _t(DAILY.format(where=USAGE_RANGE) + " order by date"),
    "serve_usage_filtered": _t(
        DAILY.format(where=f"{USAGE_RANGE} and region = 'ASIA' and device_type = 'mobile'") + " order by date"
    ),
    "serve_usage_hourly": _t(
        "select date_trunc('hour', event_time) as hour, count(distinct device_id) as daily_active_users, "
        "count(*) as total_events, count(distinct case when event_type = 'app_open' then session_id end) as total_sessions "
        f"from telemetry{USAGE_RANGE} and region = 'ASIA' group by 1 order by 1"
    ),
    "serve_crashes": _t(f"select * from ({CRASHES}) where os = 'Android' order by crash_count desc, {SEGMENT}"),
    "serve_adoption": _t(f"{RANKED} order by rank limit 5"),
    "serve_performance": _t(
        f"select * from ({PERFORMANCE.format(keys=SEGMENT)}) where device_type = 'mobile' order by {SEGMENT}"
    ),
    "sql_usage": _t(DAILY.format(where=USAGE_RANGE)),
    "sql_usage_by": _t(DAILY.format(where=f"{USAGE_RANGE} and region = 'ASIA' and device_type = 'mobile'")),
    "sql_crashes": _t(f"select * from ({CRASHES}) where os = 'Android'"),
    "sql_adoption": _t(f"select * from ({RANKED}) where rank <= 5"),
    "sql_performance": _t(f"{PERFORMANCE.format(keys=f'{SEGMENT}, metric_name')} having device_type = 'mobile' and metric_name = 'metric_1'"),
    "realtime_snapshot": _t(
        "select max(event_time) as snapshot_time, count(distinct device_id) as active_users_1m, "
        "count(*) / 60 as events_per_second, count(*) filter (event_type = 'crash_event') / count(*) as error_rate "
        "from telemetry where event_time > (select max(event_time) from telemetry) - interval '1 minute'"
    ),
    "snapshot_from_speed_layer": _t(
        "select m + interval '1 minute' as snapshot_time, sum(users)::bigint as active_users_1m, sum(n) / 60 as events_per_second, "
        "sum(crashes) / sum(n) as error_rate from (select m, region, device_type, count(distinct device_id) as users, "
        "count(*) as n, count(*) filter (event_type = 'crash_event') as crashes from "
        "(select *, time_bucket(interval '1 minute', event_time) as m from telemetry) group by 1, 2, 3) "
        "where m = (select max(time_bucket(interval '1 minute', event_time)) from telemetry "
        "where time_bucket(interval '1 minute', event_time) + interval '70 seconds' <= (select max(event_time) from telemetry)) "
        "group by m"
    ),
    "bi_top_features": _t(
        "select feature_name, total_usage, unique_users, unique_users / (select count(*) from "
        f"(select distinct device_id from telemetry)) as adoption_rate from ({RANKED}) order by rank limit 10"
    ),
    "bi_crash_rates": _t(
        f"select {SEGMENT}, crash_rate, crash_count, fatal_crashes from ({CRASHES}) where crash_rate > 0.01"
    ),
    "bi_region_usage": _t(f"select * from ({REGIONAL}) where region = 'ASIA'"),
    "bi_week_over_week": _t(
        "select *, (daily_active_users - prev_week_dau) / prev_week_dau * 100 as wow_change_pct from ("
        "select date, daily_active_users, lag(daily_active_users, 7) over (order by date) as prev_week_dau "
        f"from ({DAILY.format(where='')}))"
    ),
    # observability
    "event_rate_per_minute": _t(
        "select window_start, k.topic, k.event_type, count(event_time) as event_count, "
        f"count(event_time) / 60 as events_per_second from {_series('1 minute')} "
        "cross join (select distinct topic, event_type from telemetry) k left join "
        "(select time_bucket(interval '1 minute', event_time) as m, * from telemetry) t "
        "on m = window_start and t.topic = k.topic and t.event_type = k.event_type group by window_start, k.topic, k.event_type"
    ),
    "throughput_status": _t(
        "select window_start, n / 60 as events_per_second, "
        "case when n >= 3 then 'green' when n >= 2 then 'yellow' else 'red' end as status, n < 2 as low_throughput "
        f"from (select window_start, count(event_time) as n from {_series('1 minute')} left join "
        "(select time_bucket(interval '1 minute', event_time) as m, * from telemetry) on m = window_start group by 1)"
    ),
    "error_rate_5m": _t(
        "select window_start, n as error_count, n / 300 as errors_per_second, "
        "case when n >= 2 then 'red' when n >= 1 then 'yellow' else 'green' end as status "
        f"from (select window_start, count(event_time) filter (event_type = 'crash_event') as n from {_series('5 minutes')} "
        "left join (select time_bucket(interval '5 minutes', event_time) as m, * from telemetry) on m = window_start group by 1)"
    ),
    "histogram_buckets": _t(
        f"select metric_name, le, count(*) filter ({SECONDS} <= bound) as bucket_count "
        f"from telemetry, {BOUNDS} where event_type = 'performance_metric' group by metric_name, le"
    ),
    "histogram_quantile": _t(
        "select window_start, round(max(v) filter (q = 0.5), 6) as p50, round(max(v) filter (q = 0.95), 6) as p95 from ("
        "select window_start, q, case when le = '+Inf' then 0.25 else coalesce(lower, 0) + (bound - coalesce(lower, 0)) "
        "* (q * n - coalesce(before, 0)) / (cum - coalesce(before, 0)) end as v "
        "from (select *, lag(bound) over w as lower, lag(cum) over w as before, max(cum) over (partition by window_start, q) as n "
        f"from (select time_bucket(interval '5 minutes', event_time) as window_start, i, le, bound, q, "
        f"count(*) filter ({SECONDS} <= bound) as cum from telemetry, {BOUNDS}, (values (0.5::double), (0.95::double)) qs(q) "
        "where event_type = 'performance_metric' group by all) window w as (partition by window_start, q order by i)) "
        "where cum >= q * n qualify row_number() over (partition by window_start, q order by i) = 1) group by window_start"
    ),
    "events_by_topic": _t(
        "select topic, count(*) as event_count, count(*) / (select count(*) from telemetry) as share "
        "from telemetry group by topic"
    ),
    "latency_alerts": _t(
        "select *, mean_ms > 5000 as mean_breach, p95_ms > 5000 as p95_breach from ("
        "select date, feature_name, avg(duration_ms) as mean_ms, "
        "cast(quantile_disc(duration_ms, 0.95) as double) as p95_ms "
        "from telemetry where event_type = 'feature_used' group by date, feature_name) where mean_ms > 5000 or p95_ms > 5000"
    ),
    "run_latency_summary": _t(
        "select run, total_events, errors, errors / greatest(total_events, 1) as error_rate, coalesce(p50_ms, 0) as p50_ms, "
        "coalesce(p95_ms, 0) as p95_ms, coalesce(p99_ms, 0) as p99_ms from ("
        "select app_version as run, count(*) as total_events, count(*) filter (event_type = 'crash_event') as errors "
        "from telemetry group by 1) left join ("
        "select app_version as run, quantile_cont(cast(ms as double), 0.5) as p50_ms, "
        "cast(max(ms) filter (i = cast(floor(n * 0.95::double) as bigint)) as double) as p95_ms, "
        "cast(max(ms) filter (i = cast(floor(n * 0.99::double) as bigint)) as double) as p99_ms from ("
        "select app_version, duration_ms as ms, count(*) over (partition by app_version) as n, "
        "row_number() over (partition by app_version order by duration_ms) - 1 as i "
        "from telemetry where duration_ms is not null) group by 1) using (run)"
    ),
    # quality and routing
    "dq_envelope": ENVELOPE_REASON,
    "dq_clocks": (
        "select reason, count(k) as event_count from (values (0, 'missing'), (1, 'early'), (2, 'ahead')) r(n, reason) "
        "left join (select coalesce(cast(json_extract_string(props, '$.k') as int), 0) as k from events) on k % 25 = n group by reason"
    ),
    "dq_payload": PAYLOAD_REASON,
    "dq_os_device": _t(
        "select device_type, os, count(*) as event_count, "
        "os in ('Windows', 'macOS', 'Linux') = (device_type = 'desktop') as consistent from ("
        "select device_type, case cast(event_id as bigint) % 5 when 0 then 'iOS' when 1 then 'Android' "
        "when 2 then 'Windows' when 3 then 'macOS' else 'Linux' end as os from telemetry) group by device_type, os"
    ),
    "dq_event_mix": _t(
        "select event_type, coalesce(n, 0) as event_count, coalesce(n, 0) / (select count(*) from telemetry) as share, "
        "expected_share, round(coalesce(n, 0) / (select count(*) from telemetry) - expected_share, 6) as drift from "
        "(values ('app_open', 0.25::double), ('feature_used', 0.50::double), ('crash_event', 0.05::double), "
        "('performance_metric', 0.20::double)) x(event_type, expected_share) "
        "left join (select event_type, count(*) as n from telemetry group by 1) using (event_type) "
        "union all select 'unexpected', count(*), count(*) / (select count(*) from telemetry), 0::double, "
        "round(count(*) / (select count(*) from telemetry), 6) from telemetry where event_type not in "
        "('app_open', 'feature_used', 'crash_event', 'performance_metric')"
    ),
    "dq_region_coverage": _t(
        "select region, coalesce(n, 0) as event_count, n is not null as present, "
        "cast(count(n) over () as int) as regions_present, count(n) over () >= 4 as covered from "
        "(values ('AFRICA'), ('AMERICA'), ('ANTARCTICA'), ('ASIA'), ('EUROPE'), ('MIDDLE EAST')) x(region) "
        "left join (select region, count(*) as n from telemetry group by 1) using (region) "
        "union all select 'unexpected', count(*) filter (r is null), count(*) filter (r is null) > 0, "
        "cast(count(distinct r) as int), count(distinct r) >= 4 from (select case when region in "
        "('AFRICA', 'AMERICA', 'ANTARCTICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') then region end as r from telemetry)"
    ),
    "dq_malformed": _t(
        "select event_id as key, cast(event_id as bigint) % 10 in (3, 7) as malformed from telemetry"
    ),
    "stream_quarantine": _t(
        "select event_id as key, case when reason = 'malformed' then null else event_type end as event_type, "
        "case when reason is null then 'valid' else 'quarantined' end as status, reason from ("
        "select *, case when cast(event_id as bigint) % 10 in (3, 7) then 'malformed' "
        "when event_type = 'crash_event' then 'missing:stack_trace' "
        "when event_type = 'performance_metric' then 'missing:unit' end as reason from telemetry)"
    ),
    "route_topic": _t("select event_id, event_type, topic from telemetry"),
    "stream_dedup": _t("select event_id, topic, event_type, date as event_date, device_id from telemetry"),
    # the produced side has crashes and app opens; what arrives comes event_id % 180 seconds later
    "stream_reconcile": _t(
        "select event_id, status from (select event_id, case event_type when 'performance_metric' then 'unexpected' "
        "when 'crash_event' then case when is_fatal then 'missing' else 'matched' end else 'matched' end as status, "
        "case when event_type = 'performance_metric' then event_time + to_seconds(event_id::bigint % 180) else event_time end as seen "
        "from telemetry where event_type <> 'feature_used') where seen < (select least("
        "max(event_time) filter (event_type in ('crash_event', 'app_open')), "
        "max(event_time + to_seconds(event_id::bigint % 180)) filter (event_type in ('app_open', 'performance_metric') "
        "or (event_type = 'crash_event' and not coalesce(is_fatal, false)))) - interval '1 hour' from telemetry)"
    ),
    "reconcile_ids": _t(
        "select event_id, case event_type when 'performance_metric' then 'unexpected' "
        "when 'crash_event' then case when is_fatal then 'missing' else 'matched' end else 'matched' end as status "
        "from telemetry where event_type <> 'feature_used'"
    ),
}
