from __future__ import annotations

import sys
import tempfile
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from signalfold.schema import PAYLOAD_STRUCT, event_schema  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("signalfold-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="signalfold-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="signalfold-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_events(spark):
    """Events from dicts: envelope fields by name (text timestamps), payload fields likewise."""
    schema = event_schema(timestamp=T.TimestampNTZType())
    defaults = {
        "event_type": "feature_used", "timestamp": "2024-01-01T00:00:00", "device_id": "d1",
        "device_type": "mobile", "os": "iOS", "app_version": "2.4.1", "region": "us-east",
    }

    def make(*rows: dict):
        data = []
        for i, row in enumerate(rows):
            full = {"event_id": str(i), **defaults, **row}
            stamp = full["timestamp"]
            payload = {f.name: full.get(f.name) for f in PAYLOAD_STRUCT}
            data.append(
                (
                    full["event_id"], full["event_type"],
                    datetime.fromisoformat(stamp) if stamp else None,
                    full["device_id"], full["device_type"], full["os"], full["app_version"], full["region"],
                    payload,
                )
            )
        return spark.createDataFrame(data, schema)

    return make


def rows(df):
    """Rows as plain tuples, in the frame's order."""
    return [tuple(r) for r in df.collect()]
