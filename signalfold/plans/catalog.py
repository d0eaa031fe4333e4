"""The lake as SQL tables, and the BI queries over them."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

from signalfold.schema import EVENT, TOPICS
from signalfold.settings import LakeSettings
from signalfold.sinks.versions import current

RAW_TABLES = {topic: f"raw_{topic}" for topic in TOPICS}

# --- fixed values: columns of the stored reports ------------------------------
REPORT_COLUMNS = {
    "daily_trends": "date DATE, daily_active_users BIGINT, total_events BIGINT, total_sessions BIGINT",
    "regional_trends": "date DATE, region STRING, daily_active_users BIGINT, total_events BIGINT",
    "feature_adoption": (
        "date DATE, feature_name STRING, unique_users BIGINT, total_usage BIGINT, "
        "avg_duration_ms DOUBLE, adoption_rate DOUBLE"
    ),
    "feature_ranking": (
        "feature_name STRING, unique_users BIGINT, total_usage BIGINT, avg_duration_ms DOUBLE, "
        "avg_interactions DOUBLE, rank INT"
    ),
    "retention_cohorts": "first_seen DATE, cohort_bucket INT, retained_users BIGINT",
    "device_performance": (
        "device_type STRING, os STRING, app_version STRING, avg_metric_value DOUBLE, p50 DOUBLE, "
        "p95 DOUBLE, p99 DOUBLE, sample_count BIGINT"
    ),
    "performance_by_metric": (
        "device_type STRING, os STRING, app_version STRING, metric_name STRING, "
        "avg_metric_value DOUBLE, p50 DOUBLE, p95 DOUBLE, p99 DOUBLE, sample_count BIGINT"
    ),
    "crash_analysis": (
        "device_type STRING, os STRING, app_version STRING, crash_count BIGINT, "
        "affected_devices BIGINT, fatal_crashes BIGINT, total_devices BIGINT, crash_rate DOUBLE"
    ),
}
# -----------------------------------------------------------------------------

_DAYS = "start_date DATE DEFAULT NULL, end_date DATE DEFAULT NULL"
_IN_DAYS = "(start_date IS NULL OR {day} >= start_date) AND (end_date IS NULL OR {day} <= end_date)"
_SEGMENT = "device_type STRING, os STRING, app_version STRING"
_NUMBERS = "avg_metric_value DOUBLE, p50 DOUBLE, p95 DOUBLE, p99 DOUBLE, sample_count BIGINT"

# The serving queries as SQL table functions: name -> (tables read, parameters, columns, body). A parameter that is left out, or
# null, filters nothing. Parameters are constants where the function is used, so the filters reach the scan.
FUNCTIONS = {
    "usage_metrics": (
        ("daily_trends",), _DAYS, REPORT_COLUMNS["daily_trends"],
        f"SELECT date, daily_active_users, total_events, total_sessions FROM {{daily_trends}} WHERE {_IN_DAYS.format(day='date')}",
    ),
    "usage_metrics_by": (
        tuple(RAW_TABLES.values()), f"in_region STRING DEFAULT NULL, in_device_type STRING DEFAULT NULL, {_DAYS}", REPORT_COLUMNS["daily_trends"],
        "SELECT event_date, count(DISTINCT device_id), count(*), "
        "count(DISTINCT IF(event_type = 'app_open', payload.session_id, NULL)) FROM ("
        + " UNION ALL ".join(f"SELECT event_date, event_type, device_id, region, device_type, payload FROM {{{t}}}" for t in RAW_TABLES.values())
        + f") WHERE (in_region IS NULL OR region = in_region) AND (in_device_type IS NULL OR device_type = in_device_type) "
        f"AND {_IN_DAYS.format(day='event_date')} GROUP BY event_date",
    ),
    "crash_metrics": (
        ("crash_analysis",), "in_os STRING DEFAULT NULL, in_app_version STRING DEFAULT NULL, in_device_type STRING DEFAULT NULL",
        REPORT_COLUMNS["crash_analysis"],
        "SELECT device_type, os, app_version, crash_count, affected_devices, fatal_crashes, total_devices, crash_rate FROM {crash_analysis} "
        "WHERE (in_os IS NULL OR os = in_os) AND (in_app_version IS NULL OR app_version = in_app_version) "
        "AND (in_device_type IS NULL OR device_type = in_device_type)",
    ),
    # the ranks of one feature's rows are its own, so the limit is on the place among the rows that are left
    "adoption_metrics": (
        ("feature_ranking",), "in_feature STRING DEFAULT NULL, top_n INT DEFAULT 10", REPORT_COLUMNS["feature_ranking"],
        "SELECT feature_name, unique_users, total_usage, avg_duration_ms, avg_interactions, rank FROM {feature_ranking} "
        "WHERE (in_feature IS NULL OR feature_name = in_feature) AND (in_feature IS NOT NULL OR rank <= top_n)",
    ),
    "performance_metrics": (
        ("device_performance", "performance_by_metric"),
        "in_device_type STRING DEFAULT NULL, in_os STRING DEFAULT NULL, in_metric_name STRING DEFAULT NULL",
        f"{_SEGMENT}, metric_name STRING, {_NUMBERS}",
        "SELECT device_type, os, app_version, metric_name, avg_metric_value, p50, p95, p99, sample_count FROM ("
        "SELECT device_type, os, app_version, CAST(NULL AS STRING) AS metric_name, avg_metric_value, p50, p95, p99, sample_count "
        "FROM {device_performance} WHERE in_metric_name IS NULL UNION ALL "
        "SELECT device_type, os, app_version, metric_name, avg_metric_value, p50, p95, p99, sample_count "
        "FROM {performance_by_metric} WHERE metric_name = in_metric_name) "
        "WHERE (in_device_type IS NULL OR device_type = in_device_type) AND (in_os IS NULL OR os = in_os)",
    ),
}


def register_functions(spark: SparkSession, database: str, tables: Collection[str]) -> list[str]:
    """The serving functions that need no other tables than those named, in the database; SQL users call them as
    ``USE telemetry_db; SELECT * FROM crash_metrics(in_os => 'iOS')`` (Spark takes no database in front of a table function)."""
    names = []
    for name, (needed, parameters, columns, body) in FUNCTIONS.items():
        if set(needed) <= set(tables):
            full = {t: f"{database}.{t}" for t in needed}
            spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}({parameters}) RETURNS TABLE ({columns}) RETURN {body.format(**full)}")
            names.append(f"{database}.{name}")
    return names


def register_reports(spark: SparkSession, lake: LakeSettings, reports: Collection[str] = tuple(REPORT_COLUMNS)) -> list[str]:
    """An external Parquet table over the newest published version of each report, and the functions over them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.database}")
    names = []
    for report in reports:
        name = f"{lake.database}.{report}"
        place = current(spark, f"{lake.batch}/{report}") or f"{lake.batch}/{report}/none"
        known = spark.catalog.tableExists(name)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({REPORT_COLUMNS[report]}) USING PARQUET LOCATION '{place}'")
        if known:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            spark.catalog.refreshTable(name)
        names.append(name)
    register_functions(spark, lake.database, reports)
    return names


def sql_session(spark: SparkSession, database: str) -> SparkSession:
    """A session of the same application, with the same settings for SQL, that uses the database."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.sql(f"USE {database}")
    return session


def register_lake(spark: SparkSession, lake: LakeSettings = LakeSettings(), checked: bool = False) -> list[str]:
    """Create the database, a view per raw topic, an external Parquet table over each report, and the serving functions.

    The raw views read the landing folder by its root, where a stream keeps its commit log, and so
    see finished batches only; filters on ``event_date`` and the topic prune folders. With ``checked`` the landing is
    that of checked messages, and the views have the valid ones. Each table is over the newest published version of its
    report; one that exists is switched to it, which its readers see at once. The views and functions are renewed.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.database}")
    names = []
    columns = ", ".join([*EVENT.fieldNames(), "event_date"])
    for topic, table in RAW_TABLES.items():
        name = f"{lake.database}.{table}"
        spark.sql(
            f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{lake.raw}` "
            f"WHERE topic = '{topic}'" + (" AND status = 'valid'" if checked else "")
        )
        names.append(name)
    names += register_reports(spark, lake)
    register_functions(spark, lake.database, [*RAW_TABLES.values(), *REPORT_COLUMNS])
    return names


def raw_views(events_with_topic: DataFrame) -> dict[str, str]:
    """A temporary view per raw topic over events that have a ``topic`` column."""
    for topic, view in RAW_TABLES.items():
        events_with_topic.where(events_with_topic["topic"] == topic).createOrReplaceTempView(view)
    return RAW_TABLES


BI_QUERIES = {
    "bi_top_features": """
        SELECT feature_name, total_usage, unique_users,
               try_divide(CAST(unique_users AS DOUBLE),
                          CAST((SELECT count(*) FROM {devices}) AS DOUBLE)) AS adoption_rate
        FROM {feature_ranking} ORDER BY rank LIMIT 10""",
    "bi_crash_rates": """
        SELECT device_type, os, app_version, crash_rate, crash_count, fatal_crashes
        FROM {crash_analysis} WHERE crash_rate > {min_rate}
        ORDER BY crash_rate DESC, device_type, os, app_version""",
    "bi_region_usage": """
        SELECT date, region, daily_active_users, total_events
        FROM {regional_trends} WHERE region = {region} ORDER BY date DESC""",
    "bi_week_over_week": """
        SELECT date, daily_active_users, prev_week_dau,
               try_divide(CAST(daily_active_users - prev_week_dau AS DOUBLE),
                          CAST(prev_week_dau AS DOUBLE)) * 100 AS wow_change_pct
        FROM (SELECT date, daily_active_users,
                     LAG(daily_active_users, 7) OVER (ORDER BY date) AS prev_week_dau
              FROM {daily_trends})
        ORDER BY date DESC""",
}


def top_features(spark: SparkSession, feature_ranking: DataFrame, devices: DataFrame) -> DataFrame:
    """The ten best-ranked features, with the share of all devices that used them."""
    return spark.sql(BI_QUERIES["bi_top_features"], feature_ranking=feature_ranking, devices=devices)


def crash_rates(spark: SparkSession, crash_analysis: DataFrame, min_rate: float = 0.01) -> DataFrame:
    return spark.sql(BI_QUERIES["bi_crash_rates"], crash_analysis=crash_analysis, min_rate=min_rate)


def region_usage(spark: SparkSession, regional_trends: DataFrame, region: str = "us-east") -> DataFrame:
    return spark.sql(BI_QUERIES["bi_region_usage"], regional_trends=regional_trends, region=region)


def week_over_week(spark: SparkSession, daily_trends: DataFrame) -> DataFrame:
    """Daily users against seven rows before. The window has no partition: one row per day."""
    return spark.sql(BI_QUERIES["bi_week_over_week"], daily_trends=daily_trends)


def lake_tables(spark: SparkSession, lake: LakeSettings = LakeSettings()) -> Mapping[str, DataFrame]:
    """The registered report tables as DataFrames, as the BI queries take them."""
    return {report: spark.table(f"{lake.database}.{report}") for report in REPORT_COLUMNS}
