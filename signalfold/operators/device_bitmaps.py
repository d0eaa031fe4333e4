"""Retention without history: the active days of each device as bits.

A row holds 64 days of a device in one number, so a device has six rows a year. Adding a day touches the rows of its 64 days only;
first day, cohorts, returning and lost devices are bit operations.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.operators.retention import rates_from_cohorts

WORD = 64  # days
# the first day of a row; the sign bit alone has no negative
FIRST_DAY = f"period * {WORD} + IF(days = shiftleft(1L, {WORD - 1}), {WORD - 1}, bit_count((days & -days) - 1))"


def bitmaps(active: DataFrame) -> DataFrame:
    """``period, device_id, days`` of rows with a ``device_id`` and a ``date``; rows without either have no day. Bits are put
    together in the tasks first, so a hot device is a few rows."""
    day = F.unix_date("date")
    rows = active.where("device_id is not null and date is not null").select(
        F.floor(day / WORD).cast("int").alias("period"), "device_id", F.expr(f"shiftleft(1L, CAST(pmod(unix_date(date), {WORD}) AS int))").alias("days")
    )
    return rows.groupBy("period", "device_id").agg(F.bit_or("days").alias("days"))


def extended(stored: DataFrame, active: DataFrame) -> DataFrame:
    """The rows of the periods that ``active`` has days in, with the days that it has, whole days, in place of what ``stored`` says
    of these days. No other period of ``stored`` is read, if it lies in folders by ``period``."""
    new = bitmaps(active)
    replaced = new.groupBy("period").agg(F.bit_or("days").alias("_replaced"))
    kept = stored.join(F.broadcast(replaced), "period").select("period", "device_id", F.col("days").bitwiseAND(F.bitwise_not("_replaced")).alias("days"))
    return kept.unionByName(new).groupBy("period", "device_id").agg(F.bit_or("days").alias("days")).where("days <> 0")


def _ones(first: str, last: str) -> str:
    """SQL of a word with the bits ``first`` to ``last`` set, both in 0..63; 0 if there are none."""
    return f"IF({first} > {last}, 0L, shiftleft(shiftrightunsigned(-1L, CAST({WORD - 1} - ({last} - ({first})) AS int)), CAST({first} AS int)))"


def first_days(words: DataFrame) -> DataFrame:
    """``device_id, first_seen``."""
    return words.where("days <> 0").groupBy("device_id").agg(F.date_from_unix_date(F.min(F.expr(FIRST_DAY)).cast("int")).alias("first_seen"))


def cohorts_from_bitmaps(words: DataFrame, cohort_days: int = 7) -> DataFrame:
    """``first_seen, cohort_bucket, retained_users``, as of the events. One shuffle of the devices; a device's words are as many
    as 64 days go into the time it is known."""
    device = words.where("days <> 0").groupBy("device_id").agg(
        F.collect_list(F.struct("period", "days")).alias("words"), F.min(F.expr(FIRST_DAY)).alias("first")
    )
    start = f"(first + b * {cohort_days} - w.period * {WORD})"
    bits = _ones(f"greatest({start}, 0)", f"least({start} + {cohort_days - 1}, {WORD - 1})")
    span = f"sequence(greatest(0, (w.period * {WORD} - first) DIV {cohort_days}), (w.period * {WORD} + {WORD - 1} - first) DIV {cohort_days})"
    buckets = f"array_distinct(flatten(transform(words, w -> filter({span}, b -> (w.days & {bits}) <> 0))))"
    found = device.select(F.date_from_unix_date(F.col("first").cast("int")).alias("first_seen"), F.explode(F.expr(buckets)).alias("bucket"))
    return found.groupBy("first_seen", (F.col("bucket") * cohort_days).cast("int").alias("cohort_bucket")).agg(F.count("*").alias("retained_users"))


def retention_from_bitmaps(words: DataFrame, cohort_days: int = 7) -> DataFrame:
    """:func:`signalfold.operators.retention.retention_rates`."""
    return rates_from_cohorts(cohorts_from_bitmaps(words, cohort_days))


def _active_in(first: date, last: date) -> Column:
    """Whether the row has a day of the range."""
    lo, hi = ((d - date(1970, 1, 1)).days for d in (first, last))
    bits = _ones(f"greatest({lo} - period * {WORD}, 0)", f"least({hi} - period * {WORD}, {WORD - 1})")
    return F.expr(f"(days & {bits}) <> 0")


def lifecycle(words: DataFrame, as_of: date, span: int = 7) -> DataFrame:
    """``state, devices`` at the end of ``as_of``, by the last ``span`` days and those before: ``new`` (first seen in the last),
    ``retained`` (in both), ``returning`` (in the last and earlier, not between), ``lost`` (in the one before only), ``gone``
    (earlier only). States without a device have a row with 0."""
    recent, before = as_of - timedelta(days=span - 1), as_of - timedelta(days=2 * span - 1)
    flags = words.where(F.col("period") * WORD <= (as_of - date(1970, 1, 1)).days).groupBy("device_id").agg(
        F.bool_or(_active_in(recent, as_of)).alias("now"),
        F.bool_or(_active_in(before, recent - timedelta(days=1))).alias("before"),
        F.bool_or(_active_in(date(1970, 1, 1), before - timedelta(days=1))).alias("earlier"),
    )
    states = {
        "new": "now and not before and not earlier", "retained": "now and before", "returning": "now and not before and earlier",
        "lost": "not now and before", "gone": "not now and not before and earlier",
    }
    counts = flags.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in states.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("state"), F.col(name).alias("devices")) for name in states])
    return counts.select(F.inline(rows))
