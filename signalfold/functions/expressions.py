"""Scalar expressions shared by the operators. All are native and stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalfold.schema import DEFAULT_TOPIC, TOPIC_BY_TYPE

TIMESTAMP = "timestamp"


def event_date(timestamp: str = TIMESTAMP) -> Column:
    """Calendar day of the event. Equality on it is pushed to the scan as a range."""
    return F.to_date(F.col(timestamp))


def is_type(*event_types: str) -> Column:
    column = F.col("event_type")
    return column == event_types[0] if len(event_types) == 1 else column.isin(*event_types)


def is_fatal() -> Column:
    """True for a fatal crash, whether the payload holds a boolean or the text ``true``."""
    return F.col("payload.is_fatal").try_cast("boolean")


def number(path: str, sql_type: str = "double") -> Column:
    """Payload number; text that is no number is null instead of an ANSI error."""
    return F.col(path).try_cast(sql_type)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null where the divisor is 0 or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def bucket_start(days: Column, width: int) -> Column:
    """First day of the ``width``-day bucket that holds ``days`` (days >= 0)."""
    return (F.floor(days / F.lit(width)) * width).cast("int")


def topic_of(event_type: str = "event_type") -> Column:
    """Topic an event type is published to."""
    column = None
    for topic in dict.fromkeys(TOPIC_BY_TYPE.values()):
        types = [t for t, target in TOPIC_BY_TYPE.items() if target == topic]
        condition = F.col(event_type).isin(*types)
        column = F.when(condition, topic) if column is None else column.when(condition, topic)
    return column.otherwise(DEFAULT_TOPIC)


def step_label(value: Column, steps: Sequence[tuple[float, str]]) -> Column:
    """Label of the highest step at or below ``value``; null below the first."""
    column = None
    for start, label in sorted(steps, reverse=True):
        condition = value >= F.lit(float(start))
        column = F.when(condition, label) if column is None else column.when(condition, label)
    return column
