"""The star-schema tables seen as telemetry events.

``events`` is the fact table; what a telemetry event says about its device comes from ``customer``
and, for the region, from ``nation`` and ``region``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalfold.schema import PAYLOAD_TYPES

# --- fixed values: the star-schema columns read here, and how they map to telemetry ---
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}
K = "try_cast(get_json_object(props, '$.k') AS int)"
EVENT_TYPE = """CASE event_type WHEN 'signup' THEN 'app_open' WHEN 'error' THEN 'crash_event'
    WHEN 'purchase' THEN 'performance_metric' ELSE 'feature_used' END"""
DEVICE_TYPE = """CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'mobile'
    WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'desktop' ELSE 'tablet' END"""
OS = """CASE WHEN device_type <> 'desktop' THEN CASE WHEN k % 2 = 0 THEN 'iOS' ELSE 'Android' END
    WHEN k % 3 = 0 THEN 'Windows' WHEN k % 3 = 1 THEN 'macOS' ELSE 'Linux' END"""
APP_VERSION = """CASE user_id % 4 WHEN 0 THEN '2.3.0' WHEN 1 THEN '2.4.0' WHEN 2 THEN '2.4.1'
    ELSE '2.5.0-beta' END"""
PAYLOAD = {
    "app_open": {
        "session_id": "concat(user_id, '-', CAST(ts AS date))",
        "launch_time_ms": "k * 80",
        "is_cold_start": "k % 10 < 3",
    },
    "feature_used": {
        "feature_name": "concat('feature_', k % 15)",
        "duration_ms": "round(value * 100)",
        "interaction_count": "k % 50 + 1",
    },
    "crash_event": {
        "crash_type": "concat('crash_', k % 8)",
        "is_fatal": "k % 5 = 0",
        "memory_usage_mb": "100 + value",
    },
    "performance_metric": {
        "metric_name": "concat('metric_', k % 7)",
        "value": "value",
    },
}
# ---------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by its known schema, without a pass over the files to infer it."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def region_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_nationkey, region``, one row per nation."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left").selectExpr(
        "n_nationkey", "r_name AS region"
    )


def telemetry(
    spark: SparkSession,
    sf_dir: str,
    *,
    device: bool = True,
    region: bool = True,
    events: DataFrame | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Telemetry events in the canonical form, batch or (with a streaming ``events``) streaming.

    ``device`` and ``region`` say whether ``device_type``/``os`` and ``region`` are wanted. The
    customer key is unique, so leaving them out changes no row and saves the join with a table that
    grows with the data. Where the join stays, no side is forced to be broadcast: Spark does so only
    for a table below its size threshold, and beyond it splits hot keys of the sort-merge join
    (AQE). The events are joined with each table in turn, as the estimated size of a join of tables
    would be their product and rule out a broadcast that the sizes allow. ``shuffled`` keeps ``customer`` from being
    broadcast also below the threshold: a job that passes all events once gains little by it, and the driver collects the
    table for it.
    """
    if events is None:
        events = table(spark, sf_dir, "events")
    facts = events.selectExpr("event_id", "ts", "user_id", f"{EVENT_TYPE} AS event_type", "value", f"{K} AS k")
    if device or region:
        customer = table(spark, sf_dir, "customer")
        customer = customer.hint("merge") if shuffled else customer
        facts = facts.join(customer, facts["user_id"] == customer["c_custkey"], "left")
    if region:
        names = region_names(spark, sf_dir)
        facts = facts.join(names, facts["c_nationkey"] == names["n_nationkey"], "left")
    unknown = "CAST(NULL AS string)"
    facts = facts.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", "k",
        f"{DEVICE_TYPE if device else unknown} AS device_type",
        f"{'region' if region else unknown} AS region",
    )
    return facts.selectExpr(
        "CAST(event_id AS string) AS event_id",
        "event_type",
        "ts AS timestamp",
        "CAST(user_id AS string) AS device_id",
        "device_type",
        f"{OS if device else unknown} AS os",
        f"{APP_VERSION} AS app_version",
        "region",
        f"{_payload()} AS payload",
    )


def _payload() -> str:
    """The payload struct, with each field set for its event type only."""
    expressions = {
        name: f"CASE WHEN event_type = '{kind}' THEN {expression} END"
        for kind, fields in PAYLOAD.items()
        for name, expression in fields.items()
    }
    fields = [
        f"'{name}', CAST({expressions.get(name, 'NULL')} AS {sql_type})" for name, sql_type in PAYLOAD_TYPES.items()
    ]
    return f"named_struct({', '.join(fields)})"
