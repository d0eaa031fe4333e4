"""Published versions of a table: readers see a whole one, also while the next is written and after a run that died.

A version is a folder of its own, ``v000007``, below the table's path. It counts once its marker file is there, which is created
after all files are written, in one step. A run that dies leaves a folder without a marker, which no reader takes and the
next publication removes. Older versions stay for a while, for readers that have begun with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MARKER = "_PUBLISHED"
KEPT = 3


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, in any file system that Spark reads."""
    place, system = _file_system(spark, path)
    return system.exists(place)


def names_below(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none where there is no folder."""
    place, system = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    place, system = _file_system(spark, path)
    system.delete(place, True)


def _mark(spark: SparkSession, path: str) -> None:
    place, system = _file_system(spark, f"{path}/{MARKER}")
    system.create(place, False).close()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[1:]) for n in names_below(spark, path) if n[0] == "v" and n[1:].isdigit()]


def _place(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/v{number:06d}"


def published(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the published versions, oldest first."""
    return [n for n in sorted(_numbers(spark, path)) if exists(spark, f"{_place(path, n)}/{MARKER}")]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest published version, or None."""
    numbers = published(spark, path)
    return _place(path, numbers[-1]) if numbers else None


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version; a folder without versions is read as it is, and a missing one raises."""
    return spark.read.parquet(current(spark, path) or path)


def publish(df: DataFrame, path: str, keep: int = KEPT) -> str:
    """Write ``df`` as the next version and publish it; its folder. ``df`` may be made of the versions that are there.

    Then all but the newest ``keep`` published versions go, and what runs that died have left. Two runs at a time do not
    mix: the second to begin with a number fails.
    """
    spark = df.sparkSession
    place = _place(path, max(_numbers(spark, path), default=0) + 1)
    df.write.mode("errorifexists").parquet(place)
    _mark(spark, place)
    whole = published(spark, path)
    for n in _numbers(spark, path):
        if n < whole[-1] and n not in whole[-keep:]:
            remove(spark, _place(path, n))
    return place
