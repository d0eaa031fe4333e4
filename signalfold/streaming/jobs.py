"""The speed layer: streaming queries, their sinks, and the driver that runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from signalfold.functions.expressions import event_date
from signalfold.operators.quality import with_topic
from signalfold.operators.windows import active_users_per_minute, error_spikes, feature_usage
from signalfold.schema import normalise
from signalfold.settings import StreamSettings
from signalfold.sinks.batch import checked_rows

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"  # Spark's default


def streaming_session(spark: SparkSession, shuffle_partitions: int | None = None, state_store: str = ROCKSDB) -> SparkSession:
    """A session of the same application with its own SQL settings: state in RocksDB, off the heap, and a fixed
    number of state partitions. A stream keeps that number for the life of its checkpoint, so it comes neither
    from the batch setting nor from the cores that happen to be there. ``HEAP`` writes and drops a row of the state in a third
    of the CPU time; it is for replays, whose state is never more than a few micro-batches of a known size. These begin anew when
    they fail, so their checkpoints go without the second file that Spark writes with the checksum of each."""
    session = spark.newSession()
    partitions = shuffle_partitions or StreamSettings.state_partitions
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", state_store)
    # commit the changes of a batch, not a snapshot of all state
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    if state_store == HEAP:
        session.conf.set("spark.sql.streaming.checkpoint.fileChecksum.enabled", "false")
    return session


def speed_layer(app_events: DataFrame, crashes: DataFrame, settings: StreamSettings = StreamSettings()) -> dict[str, DataFrame]:
    """The three speed-layer aggregates by name. Inputs have a watermark."""
    return {
        "active_users": active_users_per_minute(app_events, settings.usage_window),
        "error_spikes": error_spikes(crashes, settings.error_window),
        "feature_usage": feature_usage(app_events, settings.usage_window),
    }


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """Every ``trigger`` interval, or, with none, all that is there now and then stop."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def write_parquet_stream(
    windows: DataFrame, name: str, path: str, checkpoint: str, trigger: str | None = StreamSettings.trigger
) -> StreamingQuery:
    """Window rows as Parquet, one folder per day of ``window_start``."""
    by_day = windows.withColumn("window_date", F.to_date("window_start"))
    return _start(by_day, name, path, checkpoint, trigger, "window_date")


def land_raw_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = StreamSettings.trigger,
    files_per_folder: int | None = None,
) -> StreamingQuery:
    """Events as Parquet by topic and day, with the typed payload that the batch layer reads.

    A micro-batch of fresh events touches few folders and is written as it comes. A backlog of many
    days would have every task write a file per folder; ``files_per_folder`` gathers each folder's
    rows into that many files, spread by event id so that no folder depends on one task. With the most rows that a micro-batch
    may have, over the rows of a file, a folder with all of them is still spread well.
    """
    landed = with_topic(normalise(events)).withColumn("event_date", event_date())
    if files_per_folder:
        slot = F.pmod(F.xxhash64("event_id"), F.lit(files_per_folder))
        landed = landed.repartition("topic", "event_date", slot)
    return _start(landed, "raw_landing", path, checkpoint, trigger, "topic", "event_date")


def land_checked_stream(
    checked: DataFrame, path: str, checkpoint: str, trigger: str | None = StreamSettings.trigger
) -> StreamingQuery:
    """Checked messages in one pass to the folders ``status=valid`` and ``status=quarantined``, each by topic and
    day; the loader reads the valid ones (``checked=True``)."""
    return _start(checked_rows(checked), "checked_landing", path, checkpoint, trigger, "status", "topic", "event_date")


def write_rows_stream(
    rows: DataFrame, name: str, path: str, checkpoint: str, trigger: str | None = StreamSettings.trigger
) -> StreamingQuery:
    """Rows as Parquet in one folder, as they come."""
    return _start(rows, name, path, checkpoint, trigger)


def _start(df: DataFrame, name: str, path: str, checkpoint: str, trigger: str | None, *columns: str) -> StreamingQuery:
    writer = (
        df.writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*columns)
    )
    return _triggered(writer, trigger).start()


def write_console_stream(df: DataFrame, name: str, trigger: str | None = StreamSettings.trigger, mode: str = "append") -> StreamingQuery:
    """Rows to the console, untruncated. ``update`` mode is for single-step aggregates; Spark
    refuses it for the two-step ones."""
    writer = df.writeStream.queryName(name).outputMode(mode).format("console").option("truncate", "false")
    return _triggered(writer, trigger).start()


def start_speed_layer(
    app_events: DataFrame,
    crashes: DataFrame,
    output: str,
    checkpoints: str,
    settings: StreamSettings = StreamSettings(),
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Start the three aggregates, each with its own output and checkpoint folder."""
    trigger = None if available_now else settings.trigger
    return [
        write_parquet_stream(windows, name, f"{output}/{name}", f"{checkpoints}/{name}", trigger)
        for name, windows in speed_layer(app_events, crashes, settings).items()
    ]


def await_any(spark: SparkSession) -> None:
    """Block until the first of the running queries ends, and raise if it failed."""
    spark.streams.awaitAnyTermination()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now query; raises if it failed."""
    query.awaitTermination()
