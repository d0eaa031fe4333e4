"""The JSON wire form and the quarantine of what is not in it."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalfold.operators import quality
from signalfold.schema import PAYLOAD_STRUCT, event_schema, normalise
from signalfold.settings import KafkaSettings
from signalfold.sinks.batch import write_checked
from signalfold.sources import wire
from signalfold.sources.raw import corrupt_records, load_raw_events

GOOD = (
    '{"event_id":"1","event_type":"crash_event","timestamp":"2024-01-01T00:00:07.179575","device_id":"d",'
    '"device_type":"mobile","os":"iOS","app_version":"2.4.1","region":"us-east",'
    '"payload":{"is_fatal":true,"memory_usage_mb":1.50,"extra":{"a":1}}}'
)


def messages(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "offset int, value string")


def test_decode_types_and_payload_text(spark):
    row = wire.decode(messages(spark, GOOD), timestamp_type="timestamp_ntz").first()
    assert row.timestamp == datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert row.payload == {"is_fatal": "true", "memory_usage_mb": "1.5", "extra": '{"a":1}'}
    assert dict(wire.decode(messages(spark, GOOD)).dtypes)["timestamp"] == "timestamp"


def test_bytes_decode_like_text(spark):
    text = messages(spark, GOOD)
    raw = text.select(F.col("value").cast("binary").alias("value"))
    assert rows(wire.decode(raw)) == rows(wire.decode(text))


def test_malformed(spark):
    texts = (GOOD, '{"event_id":"2","ev', "[1]", "5", "", None, "{}", GOOD.replace('{"is_fatal":true', '7,"x":{"y":1'))
    parsed = wire.parse(messages(spark, *texts), "offset").orderBy("offset")
    assert [r.malformed for r in parsed.collect()] == [False] + [True] * 7
    good, bad = quality.split_malformed(messages(spark, *texts), "offset")
    assert [r.offset for r in good.collect()] == [0]
    assert [r.value for r in bad.orderBy("offset").collect()] == list(texts[1:])


def test_bad_time_is_no_bad_json(spark):
    text = GOOD.replace("2024-01-01T00:00:07.179575", "yesterday")
    parsed = wire.parse(messages(spark, text))
    assert not parsed.first().malformed
    assert wire.typed(parsed).first().timestamp is None
    assert wire.typed(parsed).select(quality.envelope_reason()).first()[0] == "missing:timestamp"


def test_encode_decode_keeps_events(make_events):
    events = make_events(
        dict(timestamp="2024-01-01T00:00:00.000001", feature_name='a "quoted" \n name', duration_ms=5, interaction_count=2),
        dict(event_type="crash_event", is_fatal=False, memory_usage_mb=0.1, region="ä"),
        dict(event_type="performance_metric", value=1e-7, metric_name="m"),
    )
    back = normalise(wire.decode(wire.encode(events), timestamp_type="timestamp_ntz"))
    assert rows(back) == rows(events)
    assert [r.topic for r in wire.encode(events).collect()] == ["app_events", "crashes", "performance"]
    assert [r.key for r in wire.encode(events).collect()] == ["d1"] * 3


def test_normalise_accepts_map_and_partial_struct(spark):
    head = "select '1' event_id, 'app_open' event_type, timestamp '2024-01-01' timestamp, 'd' device_id, 'mobile' device_type, 'iOS' os, '1' app_version, 'r' region, "
    as_map = normalise(spark.sql(head + "map('launch_time_ms', 'x', 'is_cold_start', 'true', 'value', '1.5') payload"))
    part = normalise(spark.sql(head + "named_struct('launch_time_ms', 7L) payload"))
    assert as_map.schema["payload"].dataType.fieldNames() == PAYLOAD_STRUCT.fieldNames()
    payload = as_map.first().payload
    assert (payload.launch_time_ms, payload.is_cold_start, payload.value) == (None, True, 1.5)
    assert part.first().payload.launch_time_ms == 7 and part.first().payload.session_id is None
    assert normalise(part).schema == part.schema


def test_raw_json_scan_does_not_infer(spark, tmp_path):
    path = str(tmp_path / "raw")
    messages(spark, GOOD, "{broken", GOOD.replace('"1"', '"2"').replace("01-01T", "01-02T")).select("value").write.text(path)
    df = load_raw_events(spark, path)
    assert df.schema == event_schema()
    assert df.count() == 2 and df.select("payload.session_id").first()[0] is None
    assert [r.value for r in corrupt_records(spark, path).collect()] == ["{broken"]
    assert [r.event_id for r in load_raw_events(spark, path, date="2024-01-02").collect()] == ["2"]


def test_payload_rules(spark):
    data = [
        ("app_open", {"session_id": "s", "launch_time_ms": "12", "is_cold_start": "true"}),
        ("app_open", {"session_id": "s", "launch_time_ms": "x"}),
        ("crash_event", {"crash_type": "c", "stack_trace": "t", "is_fatal": "true", "memory_usage_mb": "1e2"}),
        ("performance_metric", {"metric_name": "m", "value": "1.5", "unit": "ms"}),  # screen_name is optional
        ("feature_used", None),
    ]
    df = spark.createDataFrame(data, T.StructType().add("event_type", "string").add("payload", T.MapType(T.StringType(), T.StringType())))
    reasons = [r[0] for r in df.select(quality.payload_reason()).collect()]
    assert reasons == [
        None, "invalid:launch_time_ms,missing:is_cold_start", None, None,
        "missing:feature_name,missing:duration_ms,missing:interaction_count",
    ]


def test_checked_rows_are_stored_in_one_pass(spark, make_events, tmp_path):
    events = make_events(dict(), dict(os=None), dict(device_type="watch"))
    write_checked(events.withColumn("reason", quality.envelope_reason()), str(tmp_path / "checked"))
    stored = spark.read.parquet(str(tmp_path / "checked"))
    assert stored.where("status = 'quarantined'").count() == 2 and stored.where("status = 'valid'").count() == 1


def test_checked_messages(spark):
    crash = GOOD.replace('"memory_usage_mb"', '"crash_type":"c","stack_trace":"t","memory_usage_mb"')
    texts = (crash, GOOD, "{", crash.replace("1.50", '"x"').replace("mobile", "watch"), crash.replace("2024-01-01T", "x"))
    checked = quality.check_messages(messages(spark, *texts), "offset").orderBy("offset").collect()
    assert [r.reason for r in checked] == [
        None, "missing:crash_type,missing:stack_trace", "malformed", "invalid:device_type,invalid:memory_usage_mb",
        "missing:timestamp",
    ]
    assert [r.text for r in checked] == [None, *texts[1:]]
    assert checked[0].timestamp == datetime(2024, 1, 1, 0, 0, 7, 179575)


def test_kafka_options():
    source = wire.kafka_source_options(KafkaSettings(bootstrap_servers=("a:1", "b:2")), ["app_events", "crashes"])
    assert source == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "app_events,crashes",
        "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5000000",
    }
    assert wire.kafka_sink_options(KafkaSettings())["kafka.compression.type"] == "lz4"


def test_kafka_source_without_connector_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        wire.read_kafka_stream(spark, ["app_events", "crashes"])
