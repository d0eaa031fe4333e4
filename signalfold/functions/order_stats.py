"""Order statistics that no single task has to sort a whole group for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 1024
LEAST_OCTAVE, MOST_OCTAVE = -1075, 1025  # beyond the binary exponents of doubles


def magnitude_bucket(value: Column) -> Column:
    """Bucket number that never falls as ``value`` rises; about 0.07 % of the value wide, near zero as
    elsewhere. Zero has a bucket of its own, and so has either infinity. ``value`` is not NaN."""
    octaves = F.least(F.log2(F.abs(value.cast("double"))), F.lit(float(MOST_OCTAVE)))
    above_zero = F.floor((octaves - F.lit(float(LEAST_OCTAVE))) * F.lit(BUCKETS_PER_OCTAVE))
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * above_zero).cast("bigint")


def values_at(df: DataFrame, keys: Sequence[str], value: str, positions: Mapping[str, str]) -> DataFrame:
    """Exact value at given 0-based positions of each group's sorted values; null and NaN are no values.

    ``positions`` maps an output column to a SQL expression over ``n``, the group's value count.
    One row per group; a position outside ``0 .. n-1`` gives null.

    Equal values are counted before the shuffle, so a hot value is one row per task. The counts are
    then added up per magnitude bucket, which tells the bucket each position lies in, and only the
    distinct values of those buckets are put in order. The counts are read twice from one shuffle.
    """
    keys = list(keys)
    counts = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.count("*").alias("_count"))
        .withColumn("_bucket", magnitude_bucket(F.col("_value")))
    )

    group = Window.partitionBy(*keys)
    upto = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (
        counts.groupBy(*keys, "_bucket")
        .agg(F.sum("_count").alias("_in_bucket"))
        .withColumns({"n": F.sum("_in_bucket").over(group), "_upto": F.sum("_in_bucket").over(upto)})
        .selectExpr(*keys, "_bucket", "n", "_upto - _in_bucket AS _before", "_upto")
    )
    # of each bucket the positions that lie in it; one row per bucket, so that the join with it
    # cannot multiply the counts
    picks = ", ".join(f"struct('{name}' AS name, CAST({at} AS bigint) AS at)" for name, at in positions.items())
    targets = buckets.selectExpr(
        *[f"{k} AS _t_{k}" for k in keys],
        "_bucket AS _t_bucket",
        "_before",
        f"filter(array({picks}), p -> p.at >= _before AND p.at < _upto) AS _picks",
    ).where("size(_picks) > 0")

    # null-safe throughout: a plain equality would add a null filter to one reading of the counts
    # and so keep the two readings from sharing their shuffle
    same_bucket = " AND ".join(["_bucket <=> _t_bucket", *[f"{k} <=> _t_{k}" for k in keys]])
    inside = counts.join(targets, F.expr(same_bucket))
    running = (
        Window.partitionBy(*keys, "_bucket").orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = inside.withColumn("_end", F.col("_before") + F.sum("_count").over(running))
    hit = "exists(_picks, p -> p.name = '{0}' AND p.at >= _end - _count AND p.at < _end)"
    return placed.groupBy(*keys).agg(
        *[F.expr(f"max(CASE WHEN {hit.format(name)} THEN _value END)").alias(name) for name in positions]
    )
