"""Bounded writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalfold.functions.expressions import event_date
from signalfold.operators.quality import status_of, with_topic
from signalfold.schema import normalise, typed_payload
from signalfold.session import workspace
from signalfold.settings import KafkaSettings, LakeSettings, LookupSettings, StreamSettings
from signalfold.sinks.versions import exists, names_below, published, read_current, remove
from signalfold.sinks.versions import publish as publish_version
from signalfold.sources.wire import encode, kafka_sink_options

# what tells the rows of the stored reports with a date apart
REPORT_KEYS = {"daily_trends": ("date",), "regional_trends": ("date", "region"), "feature_adoption": ("date", "feature_name")}


def write_reports(reports: Mapping[str, DataFrame], path: str) -> None:
    """Each report as the next version of its folder (:mod:`signalfold.sinks.versions`), so that the last one can be read until
    the new one is whole. Reports are small and read back with a sort, so they are written unsorted; they are
    submitted together, as no single one of them fills a cluster. The first failure is raised."""

    def write(item: tuple[str, DataFrame]) -> None:
        name, report = item
        publish_version(report, f"{path.rstrip('/')}/{name}")

    if not reports:
        return
    session = next(iter(reports.values())).sparkSession
    with ThreadPoolExecutor(max_workers=len(reports)) as pool:
        list(pool.map(inheritable_thread_target(session)(write), reports.items()))


def write_partitioned(
    df: DataFrame, path: str, *columns: str, fmt: str = "parquet", mode: str = "append", lookup: LookupSettings | None = None
) -> None:
    """Folders by ``columns``. The rebalance hint gathers a folder's rows into files of the advisory
    size: small folders get one file, and one that holds a third of all rows is split over tasks.

    ``append`` adds files; ``overwrite`` replaces exactly the folders that ``df`` has rows for, and leaves the others. With
    ``lookup``, the files are laid out for :mod:`signalfold.sources.lookup`.
    """
    rows = df.hint("rebalance", *columns)
    if lookup:
        # the writer sorts a task's rows by folder anyway
        rows = rows.sortWithinPartitions(*columns, *lookup.order)
    writer = rows.write.mode(mode).format(fmt).partitionBy(*columns)
    if lookup:
        writer = writer.options(**lookup_options(lookup))
    writer.option("partitionOverwriteMode", "dynamic").save(path)


def lookup_options(lookup: LookupSettings) -> dict[str, str]:
    """Parquet options for files with Bloom filters, of a size fitted to the values of each row group."""
    options = {
        "parquet.block.size": str(lookup.row_group_bytes),
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.max.bytes": str(lookup.filter_bytes),
    }
    for column in lookup.bloom:
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.fpp#{column}"] = str(lookup.false_positives)
    return options


def refuse_streamed(spark: SparkSession, path: str) -> None:
    """A stream's commit log names the files that count: a batch write next to it would not be read, or would delete it."""
    if exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"a stream lands in {path}; give the batch a folder of its own")


def land_raw(events: DataFrame, path: str, replace_days: bool = False, lookup: LookupSettings | None = None) -> None:
    """Events as Parquet by topic and day, in the form the loader reads, beside what is there. With
    ``replace_days`` the topic-days of ``events``, and no others, are replaced, so a backfill can run again. With ``lookup``,
    events can be found by id without reading all of them."""
    refuse_streamed(events.sparkSession, path)
    landed = with_topic(normalise(events)).withColumn("event_date", event_date())
    write_partitioned(landed, path, "topic", "event_date", mode="overwrite" if replace_days else "append", lookup=lookup)


def checked_rows(checked: DataFrame, reason: str = "reason") -> DataFrame:
    """Checked events with the ``status``, ``topic`` and ``event_date`` they are stored by, and a typed payload."""
    typed = typed_payload(checked.schema["payload"].dataType).alias("payload")
    rest = [c for c in checked.columns if c != "payload"]
    return with_topic(checked.select(*rest, typed)).withColumns({"event_date": event_date(), "status": status_of(reason)})


def write_checked(checked: DataFrame, path: str, reason: str = "reason") -> None:
    """Valid rows and quarantined rows (those with a ``reason``) in one pass, in the folders
    ``status=valid`` and ``status=quarantined``, each by topic and day, beside what is there."""
    refuse_streamed(checked.sparkSession, path)
    write_partitioned(checked_rows(checked, reason), path, "status", "topic", "event_date")


def compact_days(
    spark: SparkSession, path: str, days: Sequence[date], file_rows: int = StreamSettings.landed_file_rows, lookup: LookupSettings | None = None
) -> None:
    """Rewrite the landed topic-days of ``days`` as files of about ``file_rows`` rows; with ``lookup``, laid out for lookups by id.

    The new files go to a staging folder first and then replace the days' folders; a run that fails can be run
    again. Only for folders that batches land in: a stream's own folder is compacted by landing it anew.
    """
    refuse_streamed(spark, path)
    landed = spark.read.parquet(path).where(F.col("event_date").isin(*days))
    staged = workspace(spark, "compacted")
    landed.write.partitionBy("topic", "event_date").parquet(staged)
    ready = spark.read.parquet(staged)
    rows = ready.hint("rebalance", "topic", "event_date")
    if lookup:
        rows = rows.sortWithinPartitions("topic", "event_date", *lookup.order)
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", file_rows).options(**(lookup_options(lookup) if lookup else {}))
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("topic", "event_date").parquet(path)
    remove(spark, staged)


def publish(events: DataFrame, path: str) -> None:
    """Keyed JSON messages, one folder per topic, after those that are there."""
    write_partitioned(encode(events), path, "topic")


def publish_kafka(events: DataFrame, settings: KafkaSettings = KafkaSettings()) -> None:
    """Keyed JSON messages to the topic of their type. Needs the Kafka connector."""
    encode(events).write.format("kafka").options(**kafka_sink_options(settings)).save()


def archive_cutoff(as_of: date, days_old: int = 30) -> date:
    return as_of - timedelta(days=days_old)


def archive(df: DataFrame, as_of: date, historical: str, active: str, days_old: int = 30, column: str = "date") -> None:
    """Split by age: rows older than ``days_old`` days at ``as_of`` to ``historical``, the others,
    and those without a date, to the new path ``active``.

    The folder that is read is never written to. Each run's archive has a folder of its own below
    ``historical``, named by the cut-off, so running it again after a failure replaces that folder
    and neither repeats rows nor touches an earlier run's.
    """
    cutoff = archive_cutoff(as_of, days_old)
    old = F.coalesce(F.col(column) < F.lit(cutoff), F.lit(False))
    df.where(old).write.mode("overwrite").parquet(f"{historical.rstrip('/')}/archived_before={cutoff}")
    df.where(~old).write.mode("overwrite").parquet(active)


def _cutoffs(spark: SparkSession, historical: str) -> list[date]:
    """The cut-offs of earlier archive runs, oldest first."""
    names = names_below(spark, historical)
    return [date.fromisoformat(n.removeprefix("archived_before=")) for n in names if n.startswith("archived_before=")]


def read_archive(spark: SparkSession, report: str, lake: LakeSettings = LakeSettings()) -> DataFrame:
    """The archived rows of a report, with ``archived_before``: the cut-off of the run that archived each."""
    historical = f"{lake.historical}/{report}"
    parts = [
        read_current(spark, f"{historical}/archived_before={c}").withColumn("archived_before", F.lit(c))
        for c in _cutoffs(spark, historical)
        if published(spark, f"{historical}/archived_before={c}")
    ]
    if not parts:
        return read_current(spark, f"{lake.batch}/{report}").where("false").withColumn("archived_before", F.lit(None).cast("date"))
    return reduce(DataFrame.unionByName, parts)


def _without(rows: DataFrame, gone: DataFrame, columns: Sequence[str], how: str = "left_anti") -> DataFrame:
    """The rows that equal none of ``gone`` in ``columns``, nulls being equal; with ``left_semi`` the others."""
    named = gone.select(*(F.col(c).alias(f"_{c}") for c in columns))
    return rows.join(named, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns)), how)


def archive_report(
    spark: SparkSession, report: str, as_of: date, lake: LakeSettings = LakeSettings(), keys: Sequence[str] | None = None
) -> None:
    """Move the old rows of a stored report with a ``date`` to the archive, by the lake's folders and age limit.

    A run archives the days between the last run's cut-off and its own, and of the older ones those that came late or
    have other figures than in the archive; the row of the same ``keys`` (else those in ``REPORT_KEYS``) then leaves the earlier
    run's folder. So tiers and runs share no row; the report may have been rewritten with all its history in between. A row that
    is in the archive and no longer in the report stays archived. Read the archive by :func:`read_archive`.

    Each folder and the report get a new version, in this order: the run's own archive, the earlier ones that lose rows,
    the report without the archived rows. Nothing is overwritten. A run that dies between two steps has lost no row; some are in
    two tiers until it is run again, which ends as if it had not died. A run for an earlier day than the last one raises.
    """
    keys = list(keys or REPORT_KEYS.get(report, ()))
    if not keys:
        raise ValueError(f"no keys are known of {report}")
    cutoff = archive_cutoff(as_of, lake.archive_after_days)
    historical, served = f"{lake.historical}/{report}", f"{lake.batch}/{report}"
    folder = lambda c: f"{historical}/archived_before={c}"
    runs = [c for c in _cutoffs(spark, historical) if published(spark, folder(c))]
    before = [c for c in runs if c != cutoff]
    if before and before[-1] > cutoff:
        raise ValueError(f"{report} is archived up to {before[-1]} already")
    stored = read_current(spark, served)
    columns = stored.columns
    earlier = {c: read_current(spark, folder(c)) for c in before}
    fresh = stored
    if before:
        due = F.col("date").isNull() | (F.col("date") >= F.lit(before[-1]))
        known = reduce(DataFrame.unionByName, earlier.values())
        fresh = stored.where(due).unionByName(_without(stored.where(~due), known, columns))
    if cutoff in runs:
        # what the run has archived may have left the report already
        done = read_current(spark, folder(cutoff))
        fresh = fresh.unionByName(_without(done, stored, keys))
    if before or cutoff in runs:
        fresh.write.parquet(staged := workspace(spark, "archive"))
        fresh = spark.read.schema(fresh.schema).parquet(staged)
    old = F.coalesce(F.col("date") < F.lit(cutoff), F.lit(False))
    publish_version(fresh.where(old), folder(cutoff))
    for c, rows in earlier.items():
        late = fresh.where(F.col("date") < F.lit(c))
        if not _without(rows, late, keys, "left_semi").isEmpty():
            publish_version(_without(rows, late, keys), folder(c))
    publish_version(fresh.where(~old), served)
    if before or cutoff in runs:
        remove(spark, staged)
