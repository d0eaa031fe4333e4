"""Events of a few ids, found without reading the landing.

The landing is sorted by device within its files and has Bloom filters of the event ids (``lookup`` of
:func:`signalfold.sinks.batch.land_raw`); a scan for some ids skips the row groups that can't hold any of them.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalfold.sources.raw import load_raw_events

MOST = 1000  # values of one lookup; more are a join


def any_of(column: str, values: Collection[str]) -> Column:
    """Whether ``column`` is one of ``values``, as equalities: Spark gives these to the scan one by one, where it gives a longer
    ``IN`` list only as its smallest and largest value. Halved at each level, so that no expression is deep."""
    tests = [F.col(column) == F.lit(v) for v in sorted(set(values))]
    if len(tests) > MOST:
        raise ValueError(f"{len(tests)} values are too many for a lookup; join with a table of them")
    while len(tests) > 1:
        tests = [reduce(or_, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0] if tests else F.lit(False)


def find_events(
    spark: SparkSession, path: str, event_ids: Collection[str] = (), device_ids: Collection[str] = (), date: str | None = None, topic: str | None = None
) -> DataFrame:
    """The landed events of any of the event ids or devices, of one day or topic if given. Repeated ids are one; ids that
    nothing has landed of give no row, and no ids give none at all."""
    wanted = any_of("event_id", event_ids) if event_ids else F.lit(False)
    if device_ids:
        wanted = any_of("device_id", device_ids) if not event_ids else wanted | any_of("device_id", device_ids)
    return load_raw_events(spark, path, date, "parquet", topic=topic).where(wanted)


def not_landed(spark: SparkSession, path: str, event_ids: Collection[str]) -> DataFrame:
    """``event_id``: those of the ids that nothing has landed of."""
    asked = spark.createDataFrame([(i,) for i in sorted(set(event_ids))], "event_id string")
    return asked.join(find_events(spark, path, event_ids), "event_id", "left_anti")
