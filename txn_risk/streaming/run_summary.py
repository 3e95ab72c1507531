"""Figures of a running scoring stream, from the metrics that its micro-batches report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRICS = "scoring_run"


def observed(records: DataFrame) -> DataFrame:
    """Score records that report their counts and latencies as they pass; no further pass over the data."""
    return records.observe(
        METRICS, F.count(F.lit(1)).alias("processed"), F.count_if(F.col("is_fraud_predicted") == 1).alias("flagged"),
        F.count("latency_ms").alias("timed"), F.coalesce(F.sum("latency_ms"), F.lit(0.0)).alias("latency_ms"),
        F.max("latency_ms").alias("slowest_ms"),
    )


@dataclass
class Totals:
    processed: int = 0
    flagged: int = 0
    timed: int = 0
    latency_ms: float = 0.0
    slowest_ms: float = 0.0
    busy_ms: int = 0

    @property
    def flagged_pct(self) -> float:
        return 100.0 * self.flagged / self.processed if self.processed else 0.0

    @property
    def avg_latency_ms(self) -> float:
        """From ``produced_at`` to the start of the micro-batch, over the records that have it."""
        return self.latency_ms / self.timed if self.timed else 0.0

    @property
    def rows_per_second(self) -> float:
        return 1000.0 * self.processed / self.busy_ms if self.busy_ms else 0.0


class RunSummary(StreamingQueryListener):
    """Adds up what the streams of a session report through :func:`observed`.

    One entry per query and micro-batch: a micro-batch that runs again replaces its figures. Only the last
    hundred micro-batches are kept one by one, older ones as their sum, so a stream may run for good.
    """

    KEPT = 100

    def __init__(self) -> None:
        self._closed: dict[str, Totals] = {}
        self._open: dict[str, dict[int, Totals]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(METRICS)
        if row is None:
            return
        taken = progress.durationMs.get("triggerExecution", 0) if progress.durationMs else 0
        batches = self._open.setdefault(str(progress.id), {})
        batches[progress.batchId] = Totals(
            row["processed"], row["flagged"], row["timed"], row["latency_ms"], row["slowest_ms"] or 0.0, taken
        )
        while len(batches) > self.KEPT:
            self._add(self._closed.setdefault(str(progress.id), Totals()), batches.pop(min(batches)))

    @staticmethod
    def _add(to: Totals, other: Totals) -> None:
        for name in ("processed", "flagged", "timed", "latency_ms", "busy_ms"):
            setattr(to, name, getattr(to, name) + getattr(other, name))
        to.slowest_ms = max(to.slowest_ms, other.slowest_ms)

    def totals(self, query: StreamingQuery) -> Totals:
        out = Totals()
        for part in (self._closed.get(str(query.id), Totals()), *self._open.get(str(query.id), {}).values()):
            self._add(out, part)
        return out
