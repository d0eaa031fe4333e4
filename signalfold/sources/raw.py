"""Bounded scans of raw events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalfold.functions.expressions import event_date
from signalfold.schema import EVENT

CORRUPT = "_corrupt_record"
STATUS_COLUMN = T.StructField("status", T.StringType())
LANDING_COLUMNS = (T.StructField("topic", T.StringType()), T.StructField("event_date", T.DateType()))


def load_raw_events(
    spark: SparkSession,
    path: str,
    date: str | None = None,
    fmt: str = "json",
    schema: T.StructType = EVENT,
    topic: str | None = None,
    checked: bool = False,
) -> DataFrame:
    """Raw events under ``path``, optionally of one day (``YYYY-MM-DD``).

    The schema is given, so no pass over the data is spent on inference and a field that a sample
    happens to lack is still a column. ``parquet`` means the landing folder: it has ``topic`` and
    ``event_date`` as partition columns, on which the filters prune. Read it by its root and name the
    ``topic``; a sub-folder read by itself hides the stream's commit log, and with it which of the
    files belong to finished batches. ``checked`` says that it is the landing of checked messages, of which the valid
    ones are read.

    A line of a text format that is no record is left out; :func:`corrupt_records` has those.
    """
    if fmt != "parquet":
        df = _with_corrupt(spark, path, fmt, schema).where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        return on_date(df, date) if date else df
    landed = T.StructType([*schema, *([STATUS_COLUMN] if checked else []), *LANDING_COLUMNS])
    df = spark.read.schema(landed).parquet(path)
    if checked:
        df = df.where(F.col("status") == "valid").drop("status")
    if topic:
        df = df.where(F.col("topic") == topic)
    return on_date(df, date) if date else df


def _with_corrupt(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    df = spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).format(fmt).load(path)
    # a record without any field is no event; the condition also keeps Spark from reading the corrupt column alone
    empty = F.coalesce(*[F.col(f.name).cast("string") for f in schema if isinstance(f.dataType, T.AtomicType)]).isNull()
    return df.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), F.col(CORRUPT)).when(empty, F.lit("")))


def corrupt_records(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = EVENT) -> DataFrame:
    """``value``: the text of each record under ``path`` that is no event (empty if it is a record without any field)."""
    return _with_corrupt(spark, path, fmt, schema).where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def on_date(df: DataFrame, date: str) -> DataFrame:
    """Rows of one calendar day."""
    day = F.lit(date).cast("date")
    df = df.where(event_date() == day)
    return df.where(F.col("event_date") == day) if "event_date" in df.columns else df


def union_topics(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all topics; columns and payload fields a topic lacks are null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
