"""Messages kept whole: the typed event beside the record as a VARIANT, so that fields and event types no schema names yet
survive landing and can be read later.

A VARIANT keeps values, not spelling: the order of fields and the zeros after a decimal point are not kept, and a number
of more than 38 digits becomes a double. A record that has one field twice is no record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalfold.functions.expressions import event_date
from signalfold.operators.quality import with_topic
from signalfold.schema import ENVELOPE_FIELDS, EVENT, PAYLOAD_FIELDS, PAYLOAD_MAP, typed_payload
from signalfold.sinks.batch import refuse_streamed, write_partitioned
from signalfold.sources.raw import LANDING_COLUMNS, on_date

RECORD = "record"
_FIELDS = "map<string,variant>"


def decode_open(messages: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Columns ``keep``, the envelope, the payload as a map of text, ``record`` (the message as a VARIANT), and ``text``: the
    message itself where it is no event, else null.

    No event is what is no JSON object, or one without any envelope field. A payload that is no object, or a timestamp that is
    none, is null in the typed columns and whole in ``record``. Each text is parsed once. Takes batch and streaming input.
    """
    text = F.col(value).cast("string").alias("_text")
    # a generator, as Spark would copy the parser into the filters above
    record = F.inline(F.array(F.struct(F.try_parse_json("_text").alias(RECORD))))
    parsed = messages.select(*keep, text).select(*keep, "_text", record)
    envelope = [F.try_variant_get(RECORD, f"$.{name}", "string").alias(name) for name in ENVELOPE_FIELDS]
    payload = F.try_variant_get(RECORD, "$.payload", "map<string,string>").alias("payload")
    read = parsed.select(*keep, "_text", RECORD, *envelope, payload)
    event = F.coalesce(*ENVELOPE_FIELDS).isNotNull()
    return read.select(
        *keep,
        *[F.col(n).try_cast(T.TimestampType()).alias(n) if n == "timestamp" else F.col(n) for n in ENVELOPE_FIELDS],
        "payload",
        F.when(event, F.col(RECORD)).alias(RECORD),
        F.when(~event, F.coalesce("_text", F.lit(""))).alias("text"),
    )


def land_open(messages: DataFrame, path: str, value: str = "value") -> None:
    """Messages as Parquet by status, topic and day, beside what is there: events with their record, and the text of the
    others, in one pass. An event of an unknown type goes to the default topic."""
    refuse_streamed(messages.sparkSession, path)
    decoded = decode_open(messages, value=value)
    status = F.when(F.col("text").isNull(), "valid").otherwise("quarantined")
    typed = decoded.withColumn("payload", typed_payload(PAYLOAD_MAP))
    landed = with_topic(typed).withColumns({"event_date": event_date(), "status": status})
    write_partitioned(landed, path, "status", "topic", "event_date")


def load_open(spark: SparkSession, path: str, date: str | None = None, topic: str | None = None) -> DataFrame:
    """Landed events: the typed envelope and payload, and ``record``. Filters on day and topic prune folders; a query that
    asks for no field outside the schema doesn't read ``record``."""
    columns = [*EVENT, T.StructField(RECORD, T.VariantType()), T.StructField("text", T.StringType())]
    df = spark.read.schema(T.StructType([*columns, T.StructField("status", T.StringType()), *LANDING_COLUMNS])).parquet(path)
    df = df.where(F.col("status") == "valid").drop("status", "text")
    if topic:
        df = df.where(F.col("topic") == topic)
    return on_date(df, date) if date else df


def open_field(path: str, sql_type: str = "string") -> Column:
    """A field of the record as ``sql_type``, null where it is missing or of another kind: ``payload.battery`` or, for names with
    other characters than letters, digits and ``_``, a JSON path such as ``$.payload["screen.name"]``."""
    return F.try_variant_get(RECORD, path if path.startswith("$") else f"$.{path}", sql_type)


def field_report(events: DataFrame) -> DataFrame:
    """``event_type, part, field, value_type, known, n_events``: what the records hold, field by field, with the kind of value
    (``NULL`` for a JSON null) and whether the schema knows the field. Counted with a partial step in each task, so a field that all
    events have is some rows per task."""
    # "$" as a map loses nothing: a record that is an event is an object
    top = F.map_entries(F.try_variant_get(RECORD, "$", _FIELDS))
    # the payload is one field of the envelope, or, if it is an object, its fields
    inner = F.try_variant_get(RECORD, "$.payload", _FIELDS)
    outside = F.filter(top, lambda e: (e["key"] != "payload") | inner.isNull())
    entries = F.concat(
        F.transform(outside, lambda e: F.struct(F.lit("envelope").alias("part"), e["key"].alias("field"), e["value"].alias("v"))),
        F.coalesce(
            F.transform(F.map_entries(inner), lambda e: F.struct(F.lit("payload").alias("part"), e["key"].alias("field"), e["value"].alias("v"))),
            F.array(),
        ),
    )
    kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    known = (F.col("part") == "envelope") & F.col("field").isin(*ENVELOPE_FIELDS)
    for event_type, fields in PAYLOAD_FIELDS.items():
        known = known | ((F.col("part") == "payload") & (F.col("event_type") == event_type) & F.col("field").isin(*fields))
    listed = events.select("event_type", F.inline(entries))
    return (
        listed.select("event_type", "part", "field", F.when(kind == "VOID", "NULL").otherwise(kind).alias("value_type"), known.alias("_known"))
        .groupBy("event_type", "part", "field", "value_type")
        .agg(F.coalesce(F.bool_or("_known"), F.lit(False)).alias("known"), F.count("*").alias("n_events"))
    )
