"""Records kept whole: what the schema does not name survives landing."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from signalfold.session import workspace
from signalfold.sources import open_payload as op
from signalfold.sources.wire import decode, encode

NEW = {
    "event_id": "a", "event_type": "gesture", "timestamp": "2024-01-01T00:00:00.123456", "device_id": "d",
    "payload": {"x": 1, "deep": {"z": [1, 2.5, "t"]}, "screen.name": "home", "value": "3.5", "none": None}, "client": {"major": 2},
}
NO_EVENTS = ["nope", "", None, "[1]", '""', '{"b":1}', '{"event_id":"a","event_id":"b"}']


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.fixture(scope="module")
def landed(spark):
    path = workspace(spark, "open")
    odd = [json.dumps({"event_id": 7, "payload": [1]}), json.dumps({"event_type": "app_open", "payload": {"launch_time_ms": "x"}})]
    op.land_open(messages(spark, json.dumps(NEW), *odd, *NO_EVENTS), path)
    return path


def test_a_record_is_read_back_whole(spark, landed):
    event = op.load_open(spark, landed, date="2024-01-01").withColumn("json", F.to_json("record")).drop("record").collect()
    assert [json.loads(e["json"]) for e in event] == [NEW]
    assert event[0]["timestamp"] == datetime(2024, 1, 1, 0, 0, 0, 123456) and event[0]["payload"]["value"] == 3.5
    assert event[0]["topic"] == "app_events"


def test_fields_outside_the_schema(spark, landed):
    field = op.open_field
    row = op.load_open(spark, landed).where("event_id = 'a'").select(
        field("payload.deep.z[1]", "double"), field('$.payload["screen.name"]'), field("client.major", "int"), field("payload.x.y"), field("client", "int"),
    ).first()
    assert tuple(row) == (2.5, "home", 2, None, None)


def test_what_is_no_event_is_quarantined_with_its_text(spark, landed):
    kept = [r["text"] for r in spark.read.parquet(landed).where("status = 'quarantined'").collect()]
    assert sorted(kept) == sorted(t or "" for t in NO_EVENTS)
    assert op.load_open(spark, landed).count() == 3


def test_odd_parts_are_null_and_stay_in_the_record(spark, landed):
    odd = {r["event_id"]: r for r in op.load_open(spark, landed).withColumn("json", F.to_json("record")).collect() if r["event_id"] != "a"}
    assert odd["7"]["timestamp"] is None and json.loads(odd["7"]["json"])["payload"] == [1]
    assert odd[None]["payload"]["launch_time_ms"] is None and json.loads(odd[None]["json"])["payload"] == {"launch_time_ms": "x"}


def test_field_report(spark, landed):
    found = {(r["event_type"], r["part"], r["field"]): (r["value_type"], r["known"], r["n_events"]) for r in op.field_report(op.load_open(spark, landed)).collect()}
    assert found["gesture", "payload", "deep"] == ("OBJECT", False, 1) and found["gesture", "payload", "none"] == ("NULL", False, 1)
    assert found["app_open", "payload", "launch_time_ms"] == ("STRING", True, 1)
    assert found[None, "envelope", "payload"] == ("ARRAY", False, 1) and found["gesture", "envelope", "client"][1] is False


def test_typed_columns_equal_the_closed_form(spark, make_events):
    events = make_events({"value": 1.5, "event_type": "performance_metric"}, {"duration_ms": 3, "interaction_count": 1}, {"timestamp": None})
    sent = encode(events)
    closed = decode(sent).withColumn("payload", F.map_entries("payload")).collect()
    opened = op.decode_open(sent).drop("record", "text").withColumn("payload", F.map_entries("payload")).collect()
    assert sorted(map(repr, opened)) == sorted(map(repr, closed))


def test_empty(spark):
    path = workspace(spark, "open")
    op.land_open(messages(spark).limit(0), path)
    empty = op.decode_open(messages(spark).limit(0))
    assert empty.count() == 0 and op.field_report(empty).count() == 0
