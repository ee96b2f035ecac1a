"""Structured logging: an event name and fields, as text or JSON lines, to the console, a file or both."""

from __future__ import annotations

import json
import logging
from datetime import UTC, datetime
from typing import Any

from tidemark.platform.config import Section

ROOT = "tidemark"


class _Lines(logging.Formatter):
    def __init__(self, kind: str):
        super().__init__()
        self.kind = kind

    def format(self, record: logging.LogRecord) -> str:
        fields = {"timestamp": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname.lower(), "logger": record.name, "event": record.getMessage(), **getattr(record, "fields", {})}
        if record.exc_info:
            fields["exception"] = self.formatException(record.exc_info)
        if self.kind == "json":
            return json.dumps(fields, default=str)
        head = (fields.pop(k) for k in ("timestamp", "level", "logger", "event"))
        return " ".join([*head, *(f"{k}={v}" for k, v in fields.items())])


class EventLogger:
    def __init__(self, name: str):
        self._log = logging.getLogger(f"{ROOT}.{name}")

    def info(self, event: str, **fields: Any) -> None:
        self._log.info(event, extra={"fields": fields})

    def error(self, event: str, **fields: Any) -> None:
        self._log.error(event, extra={"fields": fields}, exc_info=True)


def get_logger(name: str) -> EventLogger:
    return EventLogger(name)


def configure(settings: Section) -> None:
    """Replaces the handlers set before, so that a second call changes nothing else."""
    top = logging.getLogger(ROOT)
    for old in list(top.handlers):
        top.removeHandler(old)
        old.close()
    targets: list[logging.Handler] = []
    if settings.destination in ("console", "both"):
        targets.append(logging.StreamHandler())
    if settings.destination in ("file", "both"):
        settings.log_directory.mkdir(parents=True, exist_ok=True)
        targets.append(logging.FileHandler(settings.log_directory / "tidemark.log", encoding="utf-8"))
    for target in targets:
        target.setFormatter(_Lines(settings.format))
        top.addHandler(target)
    top.setLevel(settings.level)
    top.propagate = False
