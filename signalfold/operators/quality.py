"""Validation, quarantine, routing and reconciliation of events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.functions.expressions import ratio, topic_of
from signalfold.schema import (
    DEVICE_TYPES, ENVELOPE_FIELDS, EVENT_TYPES, EXPECTED_MIX, OS_BY_DEVICE, PAYLOAD_FIELDS, REGIONS,
)
from signalfold.sources.wire import parse


UNEXPECTED = "unexpected"


def _joined(failures: Sequence[Column]) -> Column:
    """The failures' names with commas between, null if there are none."""
    return F.nullif(F.concat_ws(",", *failures), F.lit(""))


def _failure(condition: Column, name: str) -> Column:
    return F.when(condition, F.lit(name))


def envelope_reason() -> Column:
    """All envelope rules an event breaks: ``missing:<field>``, ``invalid:event_type``,
    ``invalid:device_type``; null for a valid envelope."""
    missing = [_failure(F.col(name).isNull(), f"missing:{name}") for name in ENVELOPE_FIELDS]
    return _joined(
        [
            *missing,
            _failure(~F.col("event_type").isin(*EVENT_TYPES), "invalid:event_type"),
            _failure(~F.col("device_type").isin(*DEVICE_TYPES), "invalid:device_type"),
        ]
    )


def payload_reason() -> Column:
    """All payload rules of the event's type that a map payload breaks: a required field that is
    absent, or text that is not of the field's type."""
    failures = []
    for event_type, fields in PAYLOAD_FIELDS.items():
        applies = F.col("event_type") == event_type
        for name, (sql_type, required) in fields.items():
            value = F.col("payload")[name]
            if required:
                failures.append(_failure(applies & value.isNull(), f"missing:{name}"))
            if sql_type != "string":
                bad = value.isNotNull() & value.try_cast(sql_type).isNull()
                failures.append(_failure(applies & bad, f"invalid:{name}"))
    return _joined(failures)


def split_by_reason(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with their ``reason``. Each side reads the rows; to store both,
    :func:`signalfold.sinks.batch.write_checked` takes one pass."""
    checked = df.withColumn("reason", reason)
    return checked.where(F.col("reason").isNull()).drop("reason"), checked.where(F.col("reason").isNotNull())


def split_malformed(messages: DataFrame, *keep: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parsed messages, and the text of those that are no event. Each side reads the messages; to
    store both, :func:`signalfold.sinks.batch.write_checked` takes one pass."""
    parsed = parse(messages.withColumn("_text", F.col(value).cast("string")), *keep, "_text", value="_text")
    return (
        parsed.where(~F.col("malformed")).drop("malformed", "_text"),
        parsed.where(F.col("malformed")).select(*keep, F.col("_text").alias("value")),
    )


def check_messages(messages: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Typed events (payload as a map of text) with the columns ``keep``, the message's ``text`` where
    it is quarantined, and ``reason``: ``malformed``, or every envelope and payload rule that is broken,
    or null for a valid event. Takes batch and streaming input."""
    text = F.col(value).cast("string").alias("_text")
    parsed = parse(messages.select(*keep, text), *keep, "_text", value="_text")
    checked = parsed.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    rules = F.nullif(F.concat_ws(",", envelope_reason(), payload_reason()), F.lit(""))
    reason = F.when(F.col("malformed"), "malformed").otherwise(rules)
    return checked.select(
        *keep,
        *ENVELOPE_FIELDS,
        "payload",
        F.when(reason.isNotNull(), F.col("_text")).alias("text"),
        reason.alias("reason"),
    )


def status_of(reason: str = "reason") -> Column:
    """``valid`` without a reason, else ``quarantined``."""
    return F.when(F.col(reason).isNull(), "valid").otherwise("quarantined")


def os_is_consistent() -> Column:
    """Whether the OS is one the device type can run; false for an unknown device type."""
    consistent = F.lit(False)
    for device_type, systems in OS_BY_DEVICE.items():
        consistent = consistent | ((F.col("device_type") == device_type) & F.col("os").isin(*systems))
    return F.coalesce(consistent, F.lit(False))


def os_device_check(events: DataFrame) -> DataFrame:
    """``device_type, os, event_count, consistent``."""
    return (
        events.groupBy("device_type", "os")
        .agg(F.count("*").alias("event_count"))
        .withColumn("consistent", os_is_consistent())
    )


def event_mix(events: DataFrame, expected: Mapping[str, float] = EXPECTED_MIX) -> DataFrame:
    """``event_type, event_count, share, expected_share, drift``, one row per expected type, also
    for a type that does not occur, and one row ``unexpected`` for all other types and null; the shares
    add up to 1. Counted in one pass as a single row."""
    kinds = list(expected)
    counted = events.agg(
        F.count("*").alias("_all"),
        *[F.count_if(F.col("event_type") == kind).alias(f"_n{i}") for i, kind in enumerate(kinds)],
    )
    rows = [
        F.struct(
            F.lit(kind).alias("event_type"),
            F.col(f"_n{i}").alias("event_count"),
            F.lit(float(expected[kind])).alias("expected_share"),
        )
        for i, kind in enumerate(kinds)
    ]
    rest = F.col("_all")
    for i in range(len(kinds)):
        rest = rest - F.col(f"_n{i}")
    rows.append(
        F.struct(F.lit(UNEXPECTED).alias("event_type"), rest.alias("event_count"), F.lit(0.0).alias("expected_share"))
    )
    share = ratio(F.col("event_count"), F.col("_all"))
    return counted.select("_all", F.inline(F.array(*rows))).select(
        "event_type", "event_count", share.alias("share"), "expected_share",
        (share - F.col("expected_share")).alias("drift"),
    )


def region_coverage(events: DataFrame, expected: Sequence[str] = REGIONS, minimum: int = 4) -> DataFrame:
    """``region, event_count, present, regions_present, covered``, one row per expected region, and one row
    ``unexpected`` for all other regions and null, which is not counted in ``regions_present``."""
    counted = events.agg(
        F.count("*").alias("_all"),
        *[F.count_if(F.col("region") == region).alias(f"_n{i}") for i, region in enumerate(expected)]
    )
    present = F.lit(0)
    for i in range(len(expected)):
        present = present + F.when(F.col(f"_n{i}") > 0, 1).otherwise(0)
    rows = [
        F.struct(F.lit(region).alias("region"), F.col(f"_n{i}").alias("event_count"))
        for i, region in enumerate(expected)
    ]
    rest = F.col("_all")
    for i in range(len(expected)):
        rest = rest - F.col(f"_n{i}")
    rows.append(F.struct(F.lit(UNEXPECTED).alias("region"), rest.alias("event_count")))
    return counted.select(present.alias("regions_present"), F.inline(F.array(*rows))).select(
        "region",
        "event_count",
        (F.col("event_count") > 0).alias("present"),
        "regions_present",
        (F.col("regions_present") >= minimum).alias("covered"),
    )


def with_topic(events: DataFrame) -> DataFrame:
    """Events plus the ``topic`` they are published to."""
    return events.withColumn("topic", topic_of())


def reconcile_ids(produced: DataFrame, consumed: DataFrame, key: str = "event_id") -> DataFrame:
    """``event_id, status`` for every id of either side: ``matched``, ``missing`` (produced only) or
    ``unexpected`` (consumed only). One grouping of both sides' ids, with repeats dropped before the
    shuffle, instead of two anti joins."""
    sides = produced.select(key, F.lit(1).alias("_p"), F.lit(0).alias("_c")).unionAll(
        consumed.select(key, F.lit(0).alias("_p"), F.lit(1).alias("_c"))
    )
    status = (
        F.when((F.col("_p") == 1) & (F.col("_c") == 1), "matched")
        .when(F.col("_p") == 1, "missing")
        .otherwise("unexpected")
    )
    return (
        sides.groupBy(key)
        .agg(F.max("_p").alias("_p"), F.max("_c").alias("_c"))
        .select(key, status.alias("status"))
    )
