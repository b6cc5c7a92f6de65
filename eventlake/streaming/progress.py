"""Figures of the latest micro-batch, from Spark's own progress events."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql.streaming import StreamingQueryListener


@dataclass(frozen=True)
class Snapshot:
    active: bool = False
    batch_id: int = -1
    input_rows: int = 0
    duration_ms: int = 0
    rows_per_second: float = 0.0


class ProgressGauges(StreamingQueryListener):
    """Keeps the latest :class:`Snapshot` of the query of a given name."""

    def __init__(self, query_name: str):
        self._query_name = query_name
        self._run_id = None
        self.snapshot = Snapshot()

    def onQueryStarted(self, event) -> None:
        if event.name == self._query_name:
            self._run_id = event.runId
            self.snapshot = replace(self.snapshot, active=True)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name == self._query_name:
            self.record(
                progress.batchId,
                progress.numInputRows,
                progress.batchDuration,
                progress.processedRowsPerSecond,
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._run_id:
            self.snapshot = replace(self.snapshot, active=False)

    def record(self, batch_id: int, rows: int, duration_ms: int, rate: float) -> None:
        """Take over one batch's figures; an empty batch may report no finite rate."""
        self.snapshot = replace(
            self.snapshot,
            batch_id=batch_id,
            input_rows=rows,
            duration_ms=duration_ms,
            rows_per_second=rate if math.isfinite(rate) else 0.0,
        )
