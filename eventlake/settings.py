"""Typed settings, read from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any


@dataclass(frozen=True)
class KafkaSettings:
    bootstrap_servers: str = "localhost:9092"
    topic: str = "events"
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int = 100_000
    fail_on_data_loss: bool = False


@dataclass(frozen=True)
class StorageSettings:
    base_path: str = "s3a://lakehouse/delta"
    table_name: str = "events"
    checkpoint_path: str = "s3a://lakehouse/_checkpoints"
    endpoint: str = ""
    access_key: str = field(default="", repr=False)
    secret_key: str = field(default="", repr=False)
    path_style_access: bool = True

    @property
    def table_path(self) -> str:
        return self.path_of(self.table_name)

    def path_of(self, name: str) -> str:
        return f"{self.base_path.rstrip('/')}/{name}"

    def checkpoint_for(self, name: str) -> str:
        return f"{self.checkpoint_path.rstrip('/')}/{name}"


@dataclass(frozen=True)
class StreamSettings:
    trigger_interval: str = "10 seconds"
    shuffle_partitions: int = 8
    # Read everything available now, in one or more micro-batches, and stop.
    once: bool = False


@dataclass(frozen=True)
class DeadLetterSettings:
    enabled: bool = False
    table_name: str = "events_dlq"


@dataclass(frozen=True)
class MaintenanceSettings:
    enabled: bool = False
    every_batches: int = 50
    zorder_column: str = "eventId"
    vacuum_retention_hours: int = 168


@dataclass(frozen=True)
class MergeSettings:
    # "window": match ids within the batch's date range. "table": match ids everywhere.
    scope: str = "window"
    broadcast_bytes: int = 64 * 1024 * 1024
    rows_per_file: int = 500_000


@dataclass(frozen=True)
class AuditSettings:
    enabled: bool = False
    table_name: str = "events_audit"


@dataclass(frozen=True)
class Settings:
    kafka: KafkaSettings = KafkaSettings()
    storage: StorageSettings = StorageSettings()
    stream: StreamSettings = StreamSettings()
    dlq: DeadLetterSettings = DeadLetterSettings()
    maintenance: MaintenanceSettings = MaintenanceSettings()
    merge: MergeSettings = MergeSettings()
    audit: AuditSettings = AuditSettings()

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Defaults overridden by the environment variables of :data:`ENVIRONMENT`."""
        env = os.environ if env is None else env
        values: dict[str, dict[str, str]] = {}
        for variable, (section, name) in ENVIRONMENT.items():
            if variable in env:
                values.setdefault(section, {})[name] = env[variable]
        return cls.from_mapping(values)

    @classmethod
    def from_mapping(cls, values: Mapping[str, Mapping[str, Any]]) -> Settings:
        """Defaults overridden by ``{"storage": {"base-path": ...}, ...}``.

        Names may be written with dashes or underscores; unknown sections and names are refused.
        """
        settings = cls()
        for section, overrides in values.items():
            if section not in {f.name for f in fields(cls)}:
                raise ValueError(f"unknown settings section: {section}")
            current = getattr(settings, section)
            changed = {}
            for name, value in overrides.items():
                name = name.replace("-", "_")
                if name not in {f.name for f in fields(current)}:
                    raise ValueError(f"unknown setting: {section}.{name}")
                changed[name] = _convert(value, type(getattr(current, name)), f"{section}.{name}")
            settings = replace(settings, **{section: replace(current, **changed)})
        return settings


# The environment variables and the settings they override.
ENVIRONMENT = {
    "KAFKA_BOOTSTRAP_SERVERS": ("kafka", "bootstrap_servers"),
    "KAFKA_TOPIC": ("kafka", "topic"),
    "KAFKA_STARTING_OFFSETS": ("kafka", "starting_offsets"),
    "KAFKA_MAX_OFFSETS_PER_TRIGGER": ("kafka", "max_offsets_per_trigger"),
    "KAFKA_FAIL_ON_DATA_LOSS": ("kafka", "fail_on_data_loss"),
    "STORAGE_BASE_PATH": ("storage", "base_path"),
    "STORAGE_TABLE_NAME": ("storage", "table_name"),
    "STORAGE_CHECKPOINT_PATH": ("storage", "checkpoint_path"),
    "S3_ENDPOINT": ("storage", "endpoint"),
    "S3_ACCESS_KEY": ("storage", "access_key"),
    "S3_SECRET_KEY": ("storage", "secret_key"),
    "S3_PATH_STYLE_ACCESS": ("storage", "path_style_access"),
    "STREAM_TRIGGER_INTERVAL": ("stream", "trigger_interval"),
    "STREAM_SHUFFLE_PARTITIONS": ("stream", "shuffle_partitions"),
    "STREAM_ONCE": ("stream", "once"),
    "DLQ_ENABLED": ("dlq", "enabled"),
    "DLQ_TABLE_NAME": ("dlq", "table_name"),
    "MAINTENANCE_ENABLED": ("maintenance", "enabled"),
    "MAINTENANCE_EVERY_BATCHES": ("maintenance", "every_batches"),
    "MAINTENANCE_ZORDER_COLUMN": ("maintenance", "zorder_column"),
    "MAINTENANCE_VACUUM_RETENTION_HOURS": ("maintenance", "vacuum_retention_hours"),
    "MERGE_SCOPE": ("merge", "scope"),
    "MERGE_BROADCAST_BYTES": ("merge", "broadcast_bytes"),
    "MERGE_ROWS_PER_FILE": ("merge", "rows_per_file"),
    "AUDIT_ENABLED": ("audit", "enabled"),
    "AUDIT_TABLE_NAME": ("audit", "table_name"),
}

_TRUE = {"true", "yes", "on", "1"}
_FALSE = {"false", "no", "off", "0"}


def _convert(value: Any, kind: type, name: str) -> Any:
    if isinstance(value, kind):
        return value
    text = str(value).strip()
    if kind is bool:
        if text.lower() in _TRUE | _FALSE:
            return text.lower() in _TRUE
        raise ValueError(f"{name} must be true or false, not {value!r}")
    if kind is int:
        try:
            return int(text)
        except ValueError:
            raise ValueError(f"{name} must be a whole number, not {value!r}") from None
    return text
