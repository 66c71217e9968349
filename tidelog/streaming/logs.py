"""Structured logs and spans: JSON lines with bound context, and no values of masked fields.

Driver-side only: executors hand on rows, not log lines.
"""

from __future__ import annotations

import json
import logging
import secrets
import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import UTC, datetime

from tidelog.operators.masking import Rules

_context: ContextVar[dict] = ContextVar("tidelog-log-context", default={})
_span: ContextVar[dict | None] = ContextVar("tidelog-span", default=None)
_rules = Rules()


class Json(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        span = _span.get()
        row = {"timestamp": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname.lower(), "logger": record.name, "event": record.getMessage(), **_context.get(), **getattr(record, "fields", {})}
        if span:
            row |= {"trace_id": span["trace_id"], "span_id": span["span_id"]}
        if record.exc_info:
            row["exception"] = self.formatException(record.exc_info)
        return json.dumps({k: "***" if _rules.classify(k) != "none" else v for k, v in row.items()}, default=str)


class Console(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        row = json.loads(Json().format(record))
        rest = " ".join(f"{k}={v}" for k, v in row.items() if k not in ("timestamp", "level", "event", "logger"))
        return f"{row['timestamp']} {row['level']:8} {row['event']} {rest}".rstrip()


def configure(level: str = "INFO", kind: str = "json", stream=None) -> None:
    """The library's logs to a stream, as JSON lines or for a console."""
    handler = logging.StreamHandler(stream or sys.stdout)
    handler.setFormatter(Json() if kind == "json" else Console())
    top = logging.getLogger("tidelog")
    top.handlers[:], top.propagate = [handler], False
    top.setLevel(level.upper())


class Logger:
    def __init__(self, name: str):
        self.inner = logging.getLogger(name if name.startswith("tidelog") else f"tidelog.{name}")

    def _say(self, level: int, event: str, fields: dict, failed: bool = False) -> None:
        self.inner.log(level, event, extra={"fields": fields}, exc_info=failed)

    def debug(self, event: str, **fields) -> None:
        self._say(logging.DEBUG, event, fields)

    def info(self, event: str, **fields) -> None:
        self._say(logging.INFO, event, fields)

    def warning(self, event: str, **fields) -> None:
        self._say(logging.WARNING, event, fields)

    def error(self, event: str, **fields) -> None:
        self._say(logging.ERROR, event, fields)

    def exception(self, event: str, **fields) -> None:
        self._say(logging.ERROR, event, fields, True)


def get_logger(name: str) -> Logger:
    return Logger(name)


@contextmanager
def bound(**fields) -> Iterator[None]:
    """Fields of all lines within."""
    token = _context.set({**_context.get(), **fields})
    try:
        yield
    finally:
        _context.reset(token)


#: Where ended spans go besides the log; a list in tests, an exporter elsewhere.
exporters: list = []


@contextmanager
def span(name: str, **attributes) -> Iterator[dict]:
    """A timed piece of work, within the one around it; its end is logged, with the error that ended it."""
    outer = _span.get()
    found = {"name": name, "trace_id": outer["trace_id"] if outer else secrets.token_hex(16), "span_id": secrets.token_hex(8), "parent_id": outer["span_id"] if outer else None, "attributes": attributes, "status": "ok"}
    token, began = _span.set(found), time.perf_counter()
    try:
        yield found
    except Exception as e:
        found |= {"status": "error", "error": str(e)[:500]}
        raise
    finally:
        found["duration_ms"] = round((time.perf_counter() - began) * 1000, 3)
        get_logger(__name__).info("span", name=name, parent_id=found["parent_id"], duration_ms=found["duration_ms"], status=found["status"], **attributes)
        for export in exporters:
            export(found)
        _span.reset(token)
