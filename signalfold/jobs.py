"""The complete jobs, for spark-submit: ``jobs.py batch`` and ``jobs.py stream``.

Settings come from the environment (``SIGNALFOLD_LAKE_ROOT``, ``SIGNALFOLD_KAFKA_BOOTSTRAP_SERVERS``, ...). The stream
job reads the three topics, lands checked messages and runs the speed layer; the batch job reads what was landed,
extends the roll-ups, writes the reports and registers the tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalfold.operators.quality import check_messages
from signalfold.plans.batch import run_batch
from signalfold.plans.catalog import register_lake
from signalfold.schema import TOPICS
from signalfold.session import build_session
from signalfold.settings import Settings
from signalfold.sources.raw import load_raw_events
from signalfold.sources.wire import events_of, read_kafka_messages, read_message_files
from signalfold.streaming import jobs
from signalfold.streaming.dedup import ARRIVAL, first_arrivals, with_arrival


def batch(spark: SparkSession, settings: Settings = Settings(), since: str | None = None) -> list[str]:
    """All reports and tables from the checked landing. ``since`` (``YYYY-MM-DD``) is the first day whose events the
    roll-ups don't hold yet, or hold in part; without it all days are rolled up. Returns the tables' names."""
    events = load_raw_events(spark, settings.lake.raw, fmt="parquet", checked=True)
    new = events.where(F.col("event_date") >= F.lit(since).cast("date")) if since else None
    run_batch(events, settings, new)
    return register_lake(spark, settings.lake, checked=True)


def stream(
    session: SparkSession, checkpoints: str, settings: Settings = Settings(), files: str | None = None, available_now: bool = False
) -> list[StreamingQuery]:
    """Start the checked landing and the speed layer, on Kafka or on text files of messages below ``files``. A message that
    the producer has sent twice is landed and counted once.

    ``session`` is one of :func:`signalfold.streaming.jobs.streaming_session`. The queries read the source each for
    itself, from their own checkpoints, so one that fails holds up no other.
    """

    def messages() -> DataFrame:
        if files:
            return with_arrival(read_message_files(session, files, settings.stream))
        return with_arrival(read_kafka_messages(session, TOPICS, settings.kafka), "timestamp")

    trigger = None if available_now else settings.stream.trigger
    checked = first_arrivals(check_messages(messages(), ARRIVAL), within=settings.stream.dedup_within).drop(ARRIVAL)
    landing = jobs.land_checked_stream(checked, settings.lake.raw, f"{checkpoints}/checked_landing", trigger)
    events = first_arrivals(events_of(messages(), settings.stream), arrival="timestamp", watermark=False)
    return [landing, *jobs.start_speed_layer(events, events, settings.lake.metrics, checkpoints, settings.stream, available_now)]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=("batch", "stream"))
    parser.add_argument("--since", help="batch: first day to roll up, YYYY-MM-DD")
    parser.add_argument("--checkpoints", help="stream: folder of the checkpoints")
    parser.add_argument("--files", help="stream: folder of message files, in Kafka's place")
    parser.add_argument("--available-now", action="store_true", help="stream: take what is there and stop")
    given = parser.parse_args(arguments)
    settings = Settings.from_env()
    spark = build_session(f"signalfold-{given.job}")
    if given.job == "batch":
        batch(spark, settings, given.since)
        return
    if not given.checkpoints:
        parser.error("stream needs --checkpoints")
    session = jobs.streaming_session(spark, settings.stream.state_partitions)
    queries = stream(session, given.checkpoints, settings, given.files, given.available_now)
    if given.available_now:
        for query in queries:
            jobs.run_to_end(query)
    else:
        jobs.await_any(session)


if __name__ == "__main__":
    main()
