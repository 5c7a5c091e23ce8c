"""Watching and stopping streaming queries."""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass, field

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class Totals:
    """What a query's batches add up to."""

    batches: int = 0
    rows: int = 0
    late_rows: int = 0
    state_rows: int = 0
    ended: bool = False
    error: str | None = None
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)


class ProgressTotals(StreamingQueryListener):
    """Totals per query, by its id: they go on over restarts from one checkpoint.

    Observed metrics (such as the number of malformed lines) are added up by their names. Events come after
    the batch, on a thread of their own. Register with ``spark.streams.addListener``.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.queries: dict[str, Totals] = {}

    def of(self, query: StreamingQuery) -> Totals:
        with self._lock:
            return self.queries.setdefault(str(query.id), Totals())

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self.queries.setdefault(str(event.id), Totals()).ended = False

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            totals = self.queries.setdefault(str(progress.id), Totals())
            totals.batches += 1
            totals.rows += progress.numInputRows
            totals.late_rows += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
            totals.state_rows = sum(o.numRowsTotal for o in progress.stateOperators)
            for name, row in progress.observedMetrics.items():
                held = totals.metrics.setdefault(name, {})
                for key, value in row.asDict().items():
                    held[key] = held.get(key, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            totals = self.queries.setdefault(str(event.id), Totals())
            totals.ended, totals.error = True, event.exception


def stop_between_batches(query: StreamingQuery, timeout: float = 600.0, pause: float = 0.05) -> bool:
    """Stop ``query`` when no batch is running; False if it has not come to rest within ``timeout`` seconds.

    ``stop`` alone interrupts a running batch, which then runs again from the start at the next
    start. A query that has ended by itself counts as stopped.
    """
    until = time.monotonic() + timeout
    while query.isActive:
        status = query.status
        if not status["isTriggerActive"] and status["message"].startswith("Waiting for next trigger"):
            query.stop()
            return True
        if time.monotonic() > until:
            return False
        time.sleep(pause)
    return True
