"""Progress events as JSON lines (K5) and a rotating log (K6), on the driver."""

from __future__ import annotations

import json
import logging
import logging.handlers
import os
from datetime import datetime, timezone

from pyspark.sql.streaming import StreamingQueryListener


def setup_logging(folder: str, name: str = "orgextract") -> logging.Logger:
    os.makedirs(folder, exist_ok=True)
    log = logging.getLogger(name)
    log.setLevel(logging.INFO)
    if not log.handlers:
        log.addHandler(logging.handlers.RotatingFileHandler(os.path.join(folder, f"{name}.log"), maxBytes=5_000_000, backupCount=3))
        log.addHandler(logging.StreamHandler())
    return log


def log_event(path: str, event: str, **fields) -> None:
    """One line: ts, event and whatever the caller adds."""
    line = {"ts": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "event": event} | fields
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(line, ensure_ascii=False, default=str) + "\n")


class ProgressLog(StreamingQueryListener):
    """Writes a line per micro-batch."""

    def __init__(self, path: str):
        self.path = path

    def onQueryStarted(self, event) -> None:
        log_event(self.path, "started", id=str(event.id))

    def onQueryProgress(self, event) -> None:
        log_event(self.path, "progress", batch=event.progress.batchId, rows=event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log_event(self.path, "terminated", id=str(event.id))
