"""Puts this package where the Python workers find it."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_SENT: set[str] = set()


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def text_batches(spark: SparkSession) -> None:
    """Rows of whole texts go to Python ``BATCH_ROWS`` at a time, unless the session says otherwise: a batch is in memory twice in
    the executor and once in the worker, and Spark's own number is made for numbers."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(BATCH_ROWS))


def ship(spark: SparkSession) -> None:
    """Send the package to the workers as ``--py-files`` would, once per application, unless it is on their path: where
    PYTHONPATH names it, or where the driver runs in its folder."""
    text_batches(spark)
    paths = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    application = spark.sparkContext.applicationId
    if application in _SENT or any(p and Path(p).resolve() == ROOT for p in paths):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/signalfold", "zip", ROOT, "signalfold")
    spark.sparkContext.addPyFile(archive)
    _SENT.add(application)
