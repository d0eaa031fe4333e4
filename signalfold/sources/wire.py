"""The JSON wire form: encoding, decoding, and the streams that carry it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalfold.functions.expressions import topic_of
from signalfold.schema import ENVELOPE_FIELDS, PAYLOAD_MAP, event_schema
from signalfold.settings import KafkaSettings, StreamSettings

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# The timestamp is read as text and converted after, so that a record with a bad time can be told
# from one that is no JSON at all.
_PARSE = T.StructType(
    [
        *event_schema(payload=PAYLOAD_MAP, timestamp=T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)


def encode(events: DataFrame) -> DataFrame:
    """One keyed message per event: ``topic, key, value``, with the event as JSON text and the
    device as key. Null fields are left out of the text."""
    body = [
        F.date_format("timestamp", TIMESTAMP_FORMAT).alias(name) if name == "timestamp" else F.col(name)
        for name in ENVELOPE_FIELDS
    ]
    return events.select(
        topic_of().alias("topic"),
        F.col("device_id").alias("key"),
        F.to_json(F.struct(*body, "payload")).alias("value"),
    )


def parse(messages: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Columns ``keep`` of the input, the envelope as text, the payload as a map of text, and
    ``malformed``: no JSON object, or one whose parts have the wrong shape. Bytes and text are both
    accepted.

    The record is a one-element array that is unfolded. Spark would copy a plain ``from_json`` into
    every filter above it and parse each text several times; it does not copy generators.
    """
    text = F.col(value).cast("string")
    parsed = messages.select(*keep, F.inline(F.array(F.from_json(text, _PARSE))))
    # a record without any envelope field is no event; null or empty text gives just that
    empty = F.coalesce(*ENVELOPE_FIELDS).isNull()
    return parsed.withColumn("malformed", F.col("_corrupt_record").isNotNull() | empty).drop("_corrupt_record")


def decode(messages: DataFrame, value: str = "value", timestamp_type: str = "timestamp") -> DataFrame:
    """Envelope columns and the payload as a map of text. A malformed message gives nulls; split
    those off with :func:`signalfold.operators.quality.split_malformed` where they matter."""
    return typed(parse(messages, value=value), timestamp_type)


def typed(parsed: DataFrame, timestamp_type: str = "timestamp") -> DataFrame:
    """Envelope and payload of parsed messages, with a real timestamp (null if it is none)."""
    timestamp = F.col("timestamp").try_cast(timestamp_type).alias("timestamp")
    return parsed.select(
        *[timestamp if name == "timestamp" else F.col(name) for name in ENVELOPE_FIELDS], "payload"
    )


def kafka_source_options(settings: KafkaSettings, topics: Sequence[str]) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": ",".join(settings.bootstrap_servers),
        "subscribe": ",".join(topics),
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
    }


def kafka_sink_options(settings: KafkaSettings) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": ",".join(settings.bootstrap_servers),
        "kafka.acks": settings.acks,
        "kafka.retries": str(settings.retries),
        "kafka.batch.size": str(settings.batch_size),
        "kafka.linger.ms": str(settings.linger_ms),
        "kafka.compression.type": settings.compression,
    }


def read_kafka_stream(
    spark: SparkSession,
    topic: str | Sequence[str],
    kafka: KafkaSettings = KafkaSettings(),
    stream: StreamSettings = StreamSettings(),
) -> DataFrame:
    """Typed event stream of one topic or of several, without the messages that are no events: those are for
    :func:`signalfold.operators.quality.check_messages` over :func:`read_kafka_messages`. Needs the Kafka
    connector on the class path."""
    return events_of(read_kafka_messages(spark, topic, kafka), stream)


def read_kafka_messages(
    spark: SparkSession, topic: str | Sequence[str], kafka: KafkaSettings = KafkaSettings()
) -> DataFrame:
    """Messages as they are: ``topic, partition, offset, key, value`` and the broker's time."""
    topics = [topic] if isinstance(topic, str) else list(topic)
    return spark.readStream.format("kafka").options(**kafka_source_options(kafka, topics)).load()


def read_message_files(
    spark: SparkSession, path: str, stream: StreamSettings = StreamSettings(), max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages from text files, one per line, as ``value``."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    return read_file_stream(spark, path, schema, "text", max_files_per_trigger or stream.max_files_per_trigger)


def events_of(messages: DataFrame, stream: StreamSettings = StreamSettings()) -> DataFrame:
    """The typed events among the messages, with a watermark."""
    parsed = parse(messages)
    return with_event_time(typed(parsed.where(~F.col("malformed"))), stream.watermark)


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = StreamSettings.max_files_per_trigger,
) -> DataFrame:
    """Stream of the files under ``path``; new files become new micro-batches of a bounded number of files. The
    watermark moves between micro-batches, so files must come in event-time order, up to the watermark's delay; a
    backlog that isn't is first put into slices by :func:`stage_in_order`."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


@dataclass(frozen=True)
class Pace:
    """How a backlog of ``rows`` rows is replayed. A micro-batch costs a fixed time for the commit of each state store and for the
    driver's planning, so a backlog is a few large ones (``MICRO_BATCHES``), until one has as many rows as a live stream lands
    at a time; beyond that their number grows with the backlog. The state partitions go by the rows of a micro-batch, which the
    state holds."""

    MICRO_BATCHES = 8
    FILES = 12  # of a micro-batch, at most
    STATE_ROWS = 100_000  # of a state partition and micro-batch
    STATE_PARTITIONS = 12  # at least

    rows: int
    file_rows: int
    files_per_trigger: int
    state_partitions: int

    @classmethod
    def of(cls, rows: int, file_rows: int, files_per_trigger: int, most: int = 2 * StreamSettings.landed_file_rows) -> Pace:
        """``file_rows`` and ``files_per_trigger`` at least, ``most`` rows a micro-batch."""
        batch = max(file_rows * files_per_trigger, min(most, -(-rows // cls.MICRO_BATCHES)))
        files = min(max(files_per_trigger, cls.FILES), -(-batch // file_rows))
        return cls(rows, -(-batch // files), files, max(cls.STATE_PARTITIONS, -(-batch // cls.STATE_ROWS)))

    def admitted(self, files: int) -> int:
        """Files of a micro-batch where the backlog was staged as ``files``, which may be more, and smaller, than asked for."""
        batches = max(1, -(-self.rows // (self.file_rows * self.files_per_trigger)))
        return max(self.files_per_trigger, -(-files // batches))


def stage_in_order(
    facts: DataFrame,
    path: str,
    column: str,
    file_rows: int = StreamSettings.landed_file_rows,
    rows: int | None = None,
    times: DataFrame | None = None,
    bounds: Sequence[str] | None = None,
) -> int:
    """A bounded backlog as files of about ``file_rows`` rows, in disjoint, rising ranges of ``column``; the number of files.

    A stream that takes some files per micro-batch, in their order, has no late rows, and its state holds as many files'
    time. The file source goes by modification time, so the files get rising ones, in the order of their ranges. ``rows`` is
    about how many there are, where that is known without the pass that counts them, and ``times`` has the same values of
    ``column``, where they can be had without computing ``facts``. The bounds of the ranges are quantiles, aggregated to one row:
    a range shuffle would compute the facts once more and send the driver hundreds of their rows for every file. ``bounds`` are
    these, where they are known (:func:`quantile_cuts`).
    """
    spark = facts.sparkSession
    kind = facts.schema[column].dataType
    if bounds is None:
        count = max(1, -(-(facts.count() if rows is None else rows) // file_rows))
        ordered = (facts if times is None else times).select(F.col(column).cast(kind).alias("_t"))
        bounds = ordered.agg(quantile_cuts(F.col("_t"), count).alias("cuts")).first()["cuts"] if count > 1 else None
    bounds = list(dict.fromkeys(bounds or []))
    # rows without a time come first
    slot = F.when(F.col(column).isNotNull(), _slot(F.col(column), [F.lit(text).cast(kind) for text in bounds]))
    facts.repartitionById(len(bounds) + 1, slot).write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f for f in system.listStatus(place) if f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName())
    newest = max((f.getModificationTime() for f in files), default=0)
    for k, f in enumerate(files):
        system.setTimes(f.getPath(), newest - 1000 * (len(files) - k), -1)
    return len(files)


def quantile_cuts(value: Column, count: int) -> Column:
    """The bounds between ``count`` ranges of about equally many rows, as text, an aggregate: null without values."""
    if count < 2:
        return F.lit(None).cast("array<string>")
    # ranks within a hundredth of a range
    return F.percentile_approx(value, [k / count for k in range(1, count)], max(10_000, 100 * count)).cast("array<string>")


def _slot(value: Column, bounds: Sequence[Column]) -> Column:
    """How many of the rising ``bounds`` are below ``value``, by steps that halve."""
    if not bounds:
        return F.lit(0)
    steps = [F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))]
    below = F.array(*bounds)
    return F.aggregate(F.array(*steps), F.lit(0), lambda n, step: F.when(F.get(below, n + step - 1) < value, n + step).otherwise(n))


def with_event_time(events: DataFrame, watermark: str) -> DataFrame:
    """Watermark on the event time. Spark takes no zone-less timestamps here, hence the cast."""
    if isinstance(events.schema["timestamp"].dataType, T.TimestampNTZType):
        events = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return events.withWatermark("timestamp", watermark)
