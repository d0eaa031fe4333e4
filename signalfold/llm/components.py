"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalfold.session import workspace


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write ``frame`` to the shared work folder and read it back: lineage ends in files that outlive executors."""
    spark: SparkSession = frame.sparkSession
    path = workspace(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the table that :func:`stored` has written and ``frame`` reads."""
    spark = frame.sparkSession
    for file in frame.inputFiles()[:1]:
        place = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    moved = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "moved")
    discard(least)
    return moved


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    after = stored(moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
    discard(least)
    return after


def _state(links: DataFrame) -> tuple:
    # a sum that may wrap around is enough to see a change
    row = links.agg(F.count("*"), F.sum((F.xxhash64("u", "v") % F.lit(1_000_000_007)).cast("long"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of the links (u, v) but the smallest of each component, with that smallest node.

    Links are undirected and may repeat; self links and links with a null end say nothing. No hub is
    gathered: a node's least neighbour is an aggregate with a partial step, written to a table, and its other neighbours get it
    by a join, which Spark splits when a key is hot, as neither side is an aggregate of the same shuffle. Each round ends in
    a table in the work folder; the tables of the round before are removed.
    """
    now = _small_star(links.select("u", "v").where("u is not null and v is not null"))
    state = _state(now)
    while state[0]:
        large = _large_star(now)
        after = _small_star(large)
        discard(large)
        last, state, before, now = state, _state(after), now, after
        discard(before)
        if state == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
