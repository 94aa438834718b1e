"""Job options: one validated, typed record for a capture job."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields

# The accepted spellings of every mode option.
DECIMAL_MODES = ("precise", "double", "string")
BINARY_MODES = ("bytes", "base64", "base64-url-safe", "hex")
TIME_MODES = ("adaptive", "adaptive_time_microseconds", "connect")
GEOGRAPHY_MODES = ("geometry", "string")
VECTOR_MODES = ("string", "binary", "array")
SNAPSHOT_MODES = ("initial", "initial_only", "no_data", "when_needed")
FAILURE_MODES = ("fail", "warn", "ignore")
ARRIVAL_ORDERS = ("check", "hold", "any")
OPERATIONS = ("c", "u", "d", "t")

_OFFSET = re.compile(r"[0-9a-fA-F]+\Z")
_MASK_HASH = re.compile(r"column\.mask\.hash\.([^.]+)\.with\.salt\.(.+)")
_MASK_CHARS = re.compile(r"column\.mask\.with\.(\d+)\.chars")
_TRUNCATE = re.compile(r"column\.truncate\.to\.(\d+)\.chars")


class ConfigError(ValueError):
    """One or more options are missing or invalid."""


def bad_offsets(text: str | None) -> list[str]:
    """Elements of an ``offsets`` option that are neither hex nor ``null``."""
    if not text:
        return []
    return [e for e in text.split(",") if e.lower() != "null" and not _OFFSET.match(e)]


def parse_snapshot_mode(text: str | None) -> str:
    """Trimmed and case-insensitive; unknown text falls back to ``initial``."""
    mode = (text or "").strip().lower()
    return mode if mode in SNAPSHOT_MODES else "initial"


def split_list(text: str | list[str] | None) -> list[str]:
    """A comma-separated option as a list; lists pass through."""
    if not text:
        return []
    if isinstance(text, str):
        return [part.strip() for part in text.split(",") if part.strip()]
    return list(text)


@dataclass(frozen=True)
class CdcConfig:
    """Options of one capture job (one table of one database)."""

    topic_prefix: str = ""
    db: str = ""
    table: str = ""

    decimal_mode: str = "precise"
    binary_mode: str = "bytes"
    time_mode: str = "adaptive"
    geography_mode: str = "geometry"
    vector_mode: str = "string"
    # Names of what temporal numbers count begin with this in a message's schema; none without it.
    semantic_prefix: str | None = None

    column_include: str | None = None
    column_exclude: str | None = None
    mask_hash: dict[tuple[str, str], str] = field(default_factory=dict)
    mask_chars: dict[int, str] = field(default_factory=dict)
    truncate: dict[int, str] = field(default_factory=dict)
    propagate_columns: str | None = None
    propagate_types: str | None = None

    tombstones: bool = True
    populate_internal_id: bool = False
    skipped_operations: str = "t"
    failure_mode: str = "fail"

    snapshot_mode: str = "initial"
    offsets: str | None = None
    partitions: int = 1

    topic_delimiter: str = "."
    topic_strategy: str = "default"
    heartbeat_interval_ms: int = 0
    heartbeat_prefix: str = "__heartbeat"
    notification_channels: str | None = None
    notification_topic: str | None = None
    metric_tags: str | None = None

    # Arrival numbers across batches: fail on one that is older than the last, wait for missing ones, or neither.
    arrival_order: str = "check"
    arrival_first: int = 0
    arrival_lag: int = 0
    # Events that are written together, records and bytes that a micro-batch takes; 0 sets no limit.
    max_batch_size: int = 0
    max_queue_size: int = 0
    max_queue_bytes: int = 0

    connector_name: str = "tidemark"
    connector_version: str = "0.1.0"
    bucket_rows: int = 1 << 18
    poll_interval_ms: int = 500

    def __post_init__(self) -> None:
        object.__setattr__(self, "snapshot_mode", parse_snapshot_mode(self.snapshot_mode))
        problems = list(self._problems())
        if problems:
            raise ConfigError("; ".join(problems))

    def _problems(self):
        for name in ("topic_prefix", "db", "table"):
            if not getattr(self, name):
                yield f"{name} is required"
        if self.topic_prefix and not re.fullmatch(r"[A-Za-z0-9._-]+", self.topic_prefix):
            yield "topic_prefix may hold letters, digits, hyphens, dots and underscores only"
        for name, allowed in (
            ("decimal_mode", DECIMAL_MODES),
            ("binary_mode", BINARY_MODES),
            ("time_mode", TIME_MODES),
            ("geography_mode", GEOGRAPHY_MODES),
            ("vector_mode", VECTOR_MODES),
            ("failure_mode", FAILURE_MODES),
            ("topic_strategy", ("default", "unicode")),
            ("arrival_order", ARRIVAL_ORDERS),
        ):
            if getattr(self, name) not in allowed:
                yield f"{name} must be one of {', '.join(allowed)}"
        bad = bad_offsets(self.offsets)
        if bad:
            yield f"offsets holds invalid elements: {', '.join(bad)}"
        unknown = [o for o in split_list(self.skipped_operations) if o not in (*OPERATIONS, "none")]
        if unknown:
            yield f"skipped_operations holds unknown elements: {', '.join(unknown)}"
        if self.partitions < 1:
            yield "partitions must be at least 1"
        if self.poll_interval_ms < 1:
            yield "poll_interval_ms must be at least 1"
        for name in ("arrival_lag", "max_batch_size", "max_queue_size", "max_queue_bytes", "heartbeat_interval_ms"):
            if getattr(self, name) < 0:
                yield f"{name} must not be negative"
        if "sink" in split_list(self.notification_channels) and self.notification_topic == "":
            yield "notification_topic must not be empty"
        if self.column_include and self.column_exclude:
            yield "column_include and column_exclude cannot both be set"

    @property
    def offset_list(self) -> list[str | None] | None:
        """The ``offsets`` option as a list, ``null`` elements as None."""
        if not self.offsets:
            return None
        return [None if e.lower() == "null" else e for e in self.offsets.split(",")]

    @classmethod
    def from_options(cls, options: dict[str, str]) -> "CdcConfig":
        """Build from dotted option names, as a job file would give them."""
        values: dict[str, object] = {}
        masks: dict[str, dict] = {"mask_hash": {}, "mask_chars": {}, "truncate": {}}
        for name, text in options.items():
            if m := _MASK_HASH.fullmatch(name):
                masks["mask_hash"][(m[1], m[2])] = text
            elif m := _MASK_CHARS.fullmatch(name):
                masks["mask_chars"][int(m[1])] = text
            elif m := _TRUNCATE.fullmatch(name):
                masks["truncate"][int(m[1])] = text
            elif name in _OPTION_FIELDS:
                attribute = _OPTION_FIELDS[name]
                values[attribute] = _coerce(attribute, text)
            else:
                raise ConfigError(f"unknown option {name}")
        return cls(**values, **{k: v for k, v in masks.items() if v})


# Dotted option name -> attribute.
_OPTION_FIELDS = {
    "topic.prefix": "topic_prefix",
    "database.dbname": "db",
    "database.table": "table",
    "decimal.handling.mode": "decimal_mode",
    "binary.handling.mode": "binary_mode",
    "time.precision.mode": "time_mode",
    "geography.handling.mode": "geography_mode",
    "vector.handling.mode": "vector_mode",
    "semantic.type.prefix": "semantic_prefix",
    "column.include.list": "column_include",
    "column.exclude.list": "column_exclude",
    "column.propagate.source.type": "propagate_columns",
    "datatype.propagate.source.type": "propagate_types",
    "tombstones.on.delete": "tombstones",
    "populate.internal.id": "populate_internal_id",
    "skipped.operations": "skipped_operations",
    "event.processing.failure.handling.mode": "failure_mode",
    "snapshot.mode": "snapshot_mode",
    "offsets": "offsets",
    "topic.delimiter": "topic_delimiter",
    "topic.naming.strategy": "topic_strategy",
    "database.partitions": "partitions",
    "poll.interval.ms": "poll_interval_ms",
    "heartbeat.interval.ms": "heartbeat_interval_ms",
    "heartbeat.topics.prefix": "heartbeat_prefix",
    "notification.enabled.channels": "notification_channels",
    "notification.sink.topic.name": "notification_topic",
    "max.batch.size": "max_batch_size",
    "max.queue.size": "max_queue_size",
    "max.queue.size.in.bytes": "max_queue_bytes",
    "arrival.order": "arrival_order",
    "arrival.first": "arrival_first",
    "arrival.lag": "arrival_lag",
    "custom.metric.tags": "metric_tags",
}

_TYPES = {f.name: f.type for f in fields(CdcConfig)}


def _coerce(attribute: str, text: str) -> object:
    if _TYPES[attribute] == "bool":
        return str(text).strip().lower() == "true"
    if _TYPES[attribute] == "int":
        return int(text)
    return text
