"""Structured logs of the programs: a line of JSON for each event; warnings and errors go to standard error."""

from __future__ import annotations

import datetime
import json
import os
import sys

LEVELS = ("debug", "info", "warn", "error")


class Logger:
    """Events below the level are dropped. LOG_LEVEL sets the level where none is given."""

    def __init__(self, prefix: str = "", level: str | None = None):
        self.prefix, self.level = prefix, level or os.environ.get("LOG_LEVEL", "info")

    def child(self, prefix: str) -> Logger:
        return Logger(f"{self.prefix}:{prefix}" if self.prefix else prefix, self.level)

    def log(self, level: str, message: str, **context) -> None:
        least = LEVELS.index(self.level) if self.level in LEVELS else 1
        if LEVELS.index(level) < least:
            return
        now = datetime.datetime.now(datetime.UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")
        entry = {"timestamp": now, "level": level, "message": f"[{self.prefix}] {message}" if self.prefix else message}
        print(json.dumps(entry | ({"context": context} if context else {}), ensure_ascii=False), file=sys.stderr if level in ("warn", "error") else sys.stdout)

    def debug(self, message: str, **context) -> None:
        self.log("debug", message, **context)

    def info(self, message: str, **context) -> None:
        self.log("info", message, **context)

    def warn(self, message: str, **context) -> None:
        self.log("warn", message, **context)

    def error(self, message: str, **context) -> None:
        self.log("error", message, **context)
