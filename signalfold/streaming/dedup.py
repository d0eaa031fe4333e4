"""Repeats of an at-least-once producer, dropped from streams with keyed state that expires.

A producer that gets no answer sends again, so a message may arrive twice, minutes apart at most. The state is one row per key
of the last ``within`` of arrival time, so it is as large as the traffic of that time, whatever the age of the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalfold.settings import StreamSettings

ARRIVAL = "arrival_time"


def with_arrival(messages: DataFrame, arrival: str | None = None) -> DataFrame:
    """``messages`` with ``arrival_time``: the broker's time (``arrival``), else when the file they are in was written."""
    time = F.col(arrival) if arrival else F.col("_metadata.file_modification_time")
    return messages.select("*", time.cast(T.TimestampType()).alias(ARRIVAL))


def first_arrivals(
    messages: DataFrame,
    key: str = "event_id",
    arrival: str = ARRIVAL,
    within: str = StreamSettings.dedup_within,
    watermark: bool = True,
    known: bool = False,
) -> DataFrame:
    """Each ``key`` once: repeats that arrive up to ``within`` after the first are dropped. Rows without a key all stay, as nothing
    tells them apart.

    The time is that of arrival, which only grows, and not the event's: an event that reports an old time is not late here,
    and none is lost. A stream that has a watermark already is told apart by that one (``watermark=False``): rows it
    counts as late are dropped, as by the aggregates that follow. A batch has each key once, whatever the time between, the
    first arrival staying. ``known`` says that every row has a key: a stream is then spread by the key itself, as a join on it
    is, which so needs no shuffle of its own.
    """
    if not messages.isStreaming:
        known = messages.where(F.col(key).isNotNull())
        names = [c for c in messages.columns if c != key]
        first = known.groupBy(key).agg(F.min_by(F.struct(*names), F.col(arrival)).alias("_first"))
        return first.select(key, "_first.*").select(messages.columns).unionAll(messages.where(F.col(key).isNull()))
    timed = messages.withWatermark(arrival, within) if watermark else messages
    if known:
        return timed.dropDuplicatesWithinWatermark([key])
    # without an id a row is its own key; a null would be one key for all
    keyed = timed.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.uuid()))
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")
