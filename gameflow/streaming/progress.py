"""What running streams have done, reported batch by batch."""

from __future__ import annotations

import logging
from collections import deque
from typing import NamedTuple

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


class Progress(NamedTuple):
    """One batch: rows read, rows that were refused (key is no number), messages not yet read (None
    where the source cannot tell) and how long the batch took."""

    query: str
    batch_id: int
    rows: int
    rejected: int
    lag: int | None
    millis: int


class ProgressLog(StreamingQueryListener):
    """Logs each batch and keeps the last ones in ``seen``; add it with ``spark.streams.addListener``."""

    def __init__(self, keep: int = 1000):
        self.seen: deque[Progress] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        log.info("%s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        done = event.progress
        rejected = sum(
            row.asDict().get("n_rejected") or 0 for row in done.observedMetrics.values()
        )
        behind = [s.metrics.get("maxOffsetsBehindLatest") for s in done.sources if s.metrics]
        behind = [int(x) for x in behind if x is not None]
        found = Progress(
            done.name or str(done.id), done.batchId, done.numInputRows, rejected, max(behind) if behind else None,
            int(done.durationMs.get("triggerExecution", 0)),
        )
        self.seen.append(found)
        log.info("%s: batch %d, %d rows, %d rejected, %s behind, %d ms", *found)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("%s ended%s", event.id, f": {event.exception}" if event.exception else "")
