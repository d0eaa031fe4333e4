"""What was produced against what arrived, while both still run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.settings import StreamSettings
from signalfold.streaming.dedup import first_arrivals


def reconcile_streams(
    produced: DataFrame,
    consumed: DataFrame,
    key: str = "event_id",
    time: str = "timestamp",
    settings: StreamSettings = StreamSettings(),
) -> DataFrame:
    """``event_id, event_time, status`` of two streams with the time of each row in ``time``: ``matched`` when both sides have the
    id within ``reconcile_within`` of each other, ``missing`` (produced only) or ``unexpected`` (consumed only) once the other
    side can't come any more.

    An outer join with a watermark on both sides and a bound on the time between them: the state holds the rows of that time,
    and a row that finds no partner leaves it with its verdict. Ids are compared once per side; rows without an id can't
    be matched and are left out. Batches give all verdicts at once.
    """
    within = settings.reconcile_within

    def side(rows: DataFrame, prefix: str) -> DataFrame:
        rows = rows.where(F.col(key).isNotNull()).select(F.col(key).alias(f"{prefix}_id"), F.col(time).cast("timestamp").alias(f"{prefix}_time"))
        if rows.isStreaming:
            rows = rows.withWatermark(f"{prefix}_time", settings.watermark)
        return first_arrivals(rows, f"{prefix}_id", f"{prefix}_time", watermark=False, known=True)

    near = F.expr(
        f"p_id = c_id AND c_time >= p_time - INTERVAL {within} AND c_time <= p_time + INTERVAL {within}"
    )
    joined = side(produced, "p").join(side(consumed, "c"), near, "full_outer")
    status = F.when(F.col("c_id").isNull(), "missing").when(F.col("p_id").isNull(), "unexpected").otherwise("matched")
    return joined.select(F.coalesce("p_id", "c_id").alias(key), F.coalesce("p_time", "c_time").alias("event_time"), status.alias("status"))
