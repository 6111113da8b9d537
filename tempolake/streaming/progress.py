"""Delivery counters of running streaming queries."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

_COUNTS = ("lines", "malformed", "rejected")


def summarize(query: StreamingQuery) -> dict:
    """Rate and watermark of a query's last progress; totals come from ``ProgressCounters``."""
    last = query.lastProgress
    if last is None:
        return {"rows_per_second": None, "watermark": None}
    return {
        "rows_per_second": last.processedRowsPerSecond,
        "watermark": last.eventTime.get("watermark"),
    }


class ProgressCounters(StreamingQueryListener):
    """Running totals per query name; register with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, int]] = {}
        self.rows_per_second: dict[str, float] = {}
        self.failures: dict[str, str] = {}

    def _of(self, name: str) -> dict[str, int]:
        return self.totals.setdefault(name, defaultdict(int))

    def onQueryStarted(self, event) -> None:
        self._of(event.name)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        totals = self._of(progress.name)
        totals["batches"] += 1
        totals["rows"] += progress.numInputRows
        for metrics in progress.observedMetrics.values():
            for name in _COUNTS:
                totals[name] += metrics[name]
        self.rows_per_second[progress.name] = progress.processedRowsPerSecond

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures[str(event.id)] = event.exception
