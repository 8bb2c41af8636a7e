"""What a stream's micro-batches report, added up over the whole life of a query."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


@dataclass
class Progress:
    """Sums over the micro-batches seen so far, each counted once.

    ``late_state_rows`` are rows that stateful operators turned away because their window was
    closed; an aggregation counts them after its partial sums.  ``observed`` adds up the observed
    metrics (``DataFrame.observe``), such as the events before and after a window.
    """

    input_rows: int = 0
    late_state_rows: int = 0
    watermark: str | None = None
    observed: dict[str, int] = field(default_factory=dict)
    _seen: set = field(default_factory=set, repr=False)

    def add(self, query: StreamingQuery) -> None:
        """Take in the reports that have come since; a query remembers only its latest ones."""
        for p in query.recentProgress:
            if (p.runId, p.batchId, p.timestamp) in self._seen:
                continue
            self._seen.add((p.runId, p.batchId, p.timestamp))
            self.input_rows += p.numInputRows
            self.late_state_rows += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            self.watermark = p.eventTime.get("watermark", self.watermark)
            for metrics in p.observedMetrics.values():
                for name, value in metrics.asDict().items():
                    self.observed[name] = self.observed.get(name, 0) + (value or 0)

    @property
    def late_events(self) -> int:
        """Events that no window counted.  Exact once all windows are closed."""
        return self.observed.get("events_seen", 0) - self.observed.get("events_counted", 0)


def run_available(
    df: DataFrame, path: str, fmt: str, progress: Progress | None = None, checkpoint: str | None = None, poll: float = 0.5
) -> Progress:
    """Process everything available now into files, then stop; gives what the batches reported."""
    progress = progress or Progress()
    query = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint or f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    while not query.awaitTermination(poll):
        progress.add(query)
    progress.add(query)
    return progress
