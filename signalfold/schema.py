"""The one event schema, its domains, and the step that brings any accepted form to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the event domain -----------------------------------------
EVENT_TYPES = ("app_open", "feature_used", "crash_event", "performance_metric")
DEVICE_TYPES = ("mobile", "desktop", "tablet")
OS_BY_DEVICE = {
    "mobile": ("iOS", "Android"),
    "tablet": ("iOS", "Android"),
    "desktop": ("Windows", "macOS", "Linux"),
}
REGIONS = ("us-east", "us-west", "eu-west", "eu-central", "ap-south", "ap-east")
EXPECTED_MIX = {"app_open": 0.25, "feature_used": 0.50, "crash_event": 0.05, "performance_metric": 0.20}
TOPIC_BY_TYPE = {
    "app_open": "app_events",
    "feature_used": "app_events",
    "crash_event": "crashes",
    "performance_metric": "performance",
}
DEFAULT_TOPIC = "app_events"
TOPICS = ("app_events", "crashes", "performance")
# payload fields by event type: name -> (Spark type, required)
PAYLOAD_FIELDS = {
    "app_open": {
        "session_id": ("string", True),
        "launch_time_ms": ("bigint", True),
        "is_cold_start": ("boolean", True),
    },
    "feature_used": {
        "feature_name": ("string", True),
        "duration_ms": ("bigint", True),
        "interaction_count": ("bigint", True),
    },
    "crash_event": {
        "crash_type": ("string", True),
        "stack_trace": ("string", True),
        "is_fatal": ("boolean", True),
        "memory_usage_mb": ("double", True),
    },
    "performance_metric": {
        "metric_name": ("string", True),
        "value": ("double", True),
        "unit": ("string", True),
        "screen_name": ("string", False),
    },
}
# ----------------------------------------------------------------------------

ENVELOPE_FIELDS = (
    "event_id", "event_type", "timestamp", "device_id", "device_type", "os", "app_version", "region",
)
SEGMENT = ("device_type", "os", "app_version")
PAYLOAD_TYPES = {
    name: sql_type for fields in PAYLOAD_FIELDS.values() for name, (sql_type, _) in fields.items()
}

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType()}

PAYLOAD_STRUCT = T.StructType(
    [T.StructField(name, _TYPES[sql_type]) for name, sql_type in PAYLOAD_TYPES.items()]
)
PAYLOAD_MAP = T.MapType(T.StringType(), T.StringType())


def event_schema(
    payload: T.DataType = PAYLOAD_STRUCT, timestamp: T.DataType = T.TimestampType()
) -> T.StructType:
    """Envelope plus payload; ``timestamp`` is the only envelope column that is not text."""
    envelope = [
        T.StructField(name, timestamp if name == "timestamp" else T.StringType()) for name in ENVELOPE_FIELDS
    ]
    return T.StructType([*envelope, T.StructField("payload", payload)])


EVENT = event_schema()
WIRE = event_schema(payload=PAYLOAD_MAP)


def typed_payload(payload_type: T.DataType, payload: str = "payload") -> Column:
    """Payload of either accepted form (map of text, or a struct with any subset of the fields) as
    the full struct. Text that is not of the field's type becomes null."""
    if isinstance(payload_type, T.MapType):
        present = PAYLOAD_TYPES
    else:
        present = set(payload_type.fieldNames())
    fields = []
    for name, sql_type in PAYLOAD_TYPES.items():
        value = F.col(payload)[name] if name in present else F.lit(None)
        fields.append(value.try_cast(sql_type).alias(name))
    return F.struct(*fields)


def normalise(df: DataFrame) -> DataFrame:
    """Envelope columns and a full, typed payload struct."""
    payload_type = df.schema["payload"].dataType
    if payload_type == PAYLOAD_STRUCT:
        return df.select(*ENVELOPE_FIELDS, "payload")
    return df.select(*ENVELOPE_FIELDS, typed_payload(payload_type).alias("payload"))
