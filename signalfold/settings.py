"""Typed settings; every field is read by the code that names it.

Override with ``dataclasses.replace(Settings(), ...)``.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass, replace


@dataclass(frozen=True)
class KafkaSettings:
    bootstrap_servers: tuple[str, ...] = ("localhost:9092", "localhost:9093")
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    acks: str = "all"
    retries: int = 3
    batch_size: int = 16384
    linger_ms: int = 10
    compression: str = "lz4"
    max_offsets_per_trigger: int = 5_000_000  # the most messages of one micro-batch


@dataclass(frozen=True)
class StreamSettings:
    watermark: str = "10 seconds"
    usage_window: str = "1 minute"
    error_window: str = "30 seconds"
    trigger: str = "10 seconds"
    state_partitions: int = 200  # a stream keeps this number for the life of its checkpoint
    max_files_per_trigger: int = 1000
    landed_file_rows: int = 4_000_000  # rows of one landed or staged file
    dedup_within: str = "10 minutes"  # of arrival, in which a producer may send again
    reconcile_within: str = "10 minutes"  # between the two sides of a reconciliation


@dataclass(frozen=True)
class AlertSettings:
    min_events_per_second: float = 100.0
    max_latency_ms: float = 5000.0
    max_error_rate: float = 0.05
    # cut-offs of the throughput and error panels: first value of each colour
    throughput_steps: tuple[tuple[float, str], ...] = ((0, "red"), (500, "yellow"), (1000, "green"))
    error_steps: tuple[tuple[float, str], ...] = ((0, "green"), (1, "yellow"), (10, "red"))
    # upper bounds in seconds of the latency histogram; +Inf is implied
    latency_bounds: tuple[float, ...] = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25)


@dataclass(frozen=True)
class LookupSettings:
    """Layout of landed files for lookups. A row group is read if it may hold one of the values asked for, so with 100 of them
    a filter that is wrong for one value in 10,000 passes about one row group in 100 for nothing."""

    order: tuple[str, ...] = ("device_id",)  # within a file, so that a device is in few row groups
    bloom: tuple[str, ...] = ("event_id",)
    false_positives: float = 0.0001
    filter_bytes: int = 4 << 20  # at most, per row group and column; enough for 1.4 million values
    row_group_bytes: int = 32 << 20


@dataclass(frozen=True)
class LakeSettings:
    """Paths below one Hadoop file-system URI."""

    root: str = "/data"
    database: str = "telemetry_db"
    archive_after_days: int = 30
    device_buckets: int = 256  # of the tables by device; fixed for the life of the tables

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def batch(self) -> str:
        return f"{self.root}/processed/batch"

    @property
    def rollups(self) -> str:
        return f"{self.root}/processed/rollups"

    @property
    def device_tables(self) -> str:
        return f"{self.root}/processed/by_device"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def metrics(self) -> str:
        return f"{self.root}/processed/metrics"

    @property
    def repaired(self) -> str:
        return f"{self.root}/processed/repaired"

    @property
    def historical(self) -> str:
        return f"{self.root}/historical"


@dataclass(frozen=True)
class Settings:
    kafka: KafkaSettings = field(default_factory=KafkaSettings)
    stream: StreamSettings = field(default_factory=StreamSettings)
    alerts: AlertSettings = field(default_factory=AlertSettings)
    lake: LakeSettings = field(default_factory=LakeSettings)
    cohort_days: int = 7

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, prefix: str = "SIGNALFOLD_") -> Settings:
        """Defaults overridden by variables such as ``SIGNALFOLD_LAKE_ROOT`` or
        ``SIGNALFOLD_KAFKA_BOOTSTRAP_SERVERS`` (lists with commas). A name that fits no field raises."""
        env = os.environ if env is None else env
        settings, left = cls(), {k for k in env if k.startswith(prefix)}
        for part in fields(cls):
            section = getattr(settings, part.name)
            if not is_dataclass(section):
                if (key := f"{prefix}{part.name.upper()}") in left:
                    settings = replace(settings, **{part.name: _typed(section, env[key])})
                    left.discard(key)
                continue
            given = {f.name: f"{prefix}{part.name.upper()}_{f.name.upper()}" for f in fields(section)}
            found = {name: _typed(getattr(section, name), env[key]) for name, key in given.items() if key in left}
            settings = replace(settings, **{part.name: replace(section, **found)})
            left -= set(given.values())
        if left:
            raise ValueError(f"no such settings: {', '.join(sorted(left))}")
        return settings


def _typed(default: object, text: str) -> object:
    """``text`` as a value of the default's type."""
    if isinstance(default, bool):
        return text.strip().lower() in ("1", "true", "yes")
    if isinstance(default, tuple):
        if default and not isinstance(default[0], (str, int, float)):
            raise ValueError("this setting can't be given as text")
        kind = type(default[0]) if default else str
        return tuple(kind(x.strip()) for x in text.split(",") if x.strip())
    return type(default)(text)
