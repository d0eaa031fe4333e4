"""A filter of fixed size that keeps most rows without a partner out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def maybe_in(frame: DataFrame, column: Column, wanted: DataFrame, wanted_column: Column) -> DataFrame:
    """``frame`` with a boolean ``_maybe``: false only where ``column`` is in no row of ``wanted``; both are whole numbers.

    The values in ``wanted`` set bits of a bitmap of ``BITS`` bits (8 MB, whatever the input), which is broadcast in
    slices of 4 KB. Where it fills up at a very large size, more rows are true, and the join that follows is as right as before.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS)) + 1
    slices = (
        wanted.where(wanted_column.isNotNull())
        .select(slot(wanted_column).alias("_slot"))
        .groupBy(F.bitmap_bucket_number("_slot").alias("_slice"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    )
    placed = frame.withColumn("_slot", slot(column)).withColumn("_slice", F.bitmap_bucket_number("_slot"))
    byte = "conv(hex(substring(_bits, CAST(bitmap_bit_position(_slot) DIV 8 AS int) + 1, 1)), 16, 10)"
    bit = F.expr(f"shiftright(CAST({byte} AS int), CAST(bitmap_bit_position(_slot) % 8 AS int)) & 1 = 1")
    tested = placed.join(F.broadcast(slices), "_slice", "left").withColumn("_maybe", F.coalesce(bit, F.lit(False)))
    return tested.drop("_slot", "_slice", "_bits")


def without(frame: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """The rows of ``frame`` whose ``column`` isn't in ``gone`` (one column of whole numbers, no repeats). Rows that may be in
    it are the only ones to be shuffled."""
    value = gone.columns[0]
    tested = maybe_in(frame, F.col(column), gone, F.col(value))
    listed = gone.select(F.col(value).alias("_gone"))
    rest = tested.where("_maybe").join(listed, F.col(column) == F.col("_gone"), "left_anti")
    return tested.where("not _maybe").union(rest).select(frame.columns)
