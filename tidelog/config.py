"""Settings as frozen dataclasses, read from YAML files that are merged in order; later ones win."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any


@dataclass(frozen=True)
class Retry:
    max_attempts: int = 5
    base_ms: int = 100
    max_ms: int = 30_000
    multiplier: float = 2.0
    jitter: bool = True


@dataclass(frozen=True)
class Pipeline:
    batch_size: int = 100
    max_parallelism: int = 4
    max_in_flight_batches: int = 10
    poll_interval_ms: int = 100
    retry: Retry = field(default_factory=Retry)

    def __post_init__(self):
        if not 1 <= self.batch_size <= 10_000:
            raise ValueError("batch_size is from 1 to 10000")


@dataclass(frozen=True)
class Destination:
    enabled: bool = False
    path: str = ""
    options: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Destinations:
    postgres: Destination = field(default_factory=Destination)
    clickhouse: Destination = field(default_factory=Destination)
    timescaledb: Destination = field(default_factory=Destination)


@dataclass(frozen=True)
class Settings:
    keyspace: str = "ecommerce"
    table: str = "users"
    pipeline: Pipeline = field(default_factory=Pipeline)
    destinations: Destinations = field(default_factory=Destinations)
    source_path: str = ""
    work_path: str = ""
    dlq_path: str = "dlq"
    http_port: int = 0
    probe_interval_s: float = 30.0
    log_level: str = "INFO"
    log_format: str = "json"
    phi_key: str | None = None
    pii_salt: str = ""


def merge(*configs: dict) -> dict:
    out: dict = {}
    for c in configs:
        for k, v in (c or {}).items():
            out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def read_yaml(path: str) -> dict:
    """A file's content, `${NAME}` and `${NAME:-default}` replaced from the environment."""
    import yaml

    with open(path, encoding="utf-8") as f:
        text = re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", lambda m: os.environ.get(m[1], m[2] or ""), f.read())
    return yaml.safe_load(text) or {}


def build(cls, values: dict):
    """A dataclass of a dict; unknown names are errors."""
    known = {f.name: f for f in fields(cls)}
    if odd := values.keys() - known:
        raise ValueError(f"unknown settings: {', '.join(sorted(odd))}")
    nested = lambda k, v: build(kind, v) if isinstance(v, dict) and is_dataclass(kind := _type(cls, k)) else v
    return cls(**{k: nested(k, v) for k, v in values.items()})


def _type(cls, name: str):
    default = {f.name: f for f in fields(cls)}[name].default_factory
    return default if isinstance(default, type) else None


def load(*paths: str, **over) -> Settings:
    return build(Settings, merge(*map(read_yaml, paths), over))
