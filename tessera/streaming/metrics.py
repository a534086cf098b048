"""Counters of running streams (A11): observed in the stream's own plan, gathered by a listener."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

ROWS = "run_id string, batch long, counter string, n long"


def with_counters(events: DataFrame, name: str, counters: dict[str, F.Column]) -> DataFrame:
    """``events`` observed: per micro-batch the number of rows where each condition holds, without another pass."""
    return events.observe(name, *[F.count(F.when(c, F.lit(1))).alias(k) for k, c in counters.items()])


class CounterListener(StreamingQueryListener):
    """Keeps one row per batch and counter of the observation ``name`` (as many as batches, not rows)."""

    def __init__(self, name: str) -> None:
        self.name, self.rows, self._ended = name, [], threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names fixed by the interface
        self._ended.clear()

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        if seen is not None and p.numInputRows:
            self.rows += [(str(p.runId), p.batchId, k, int(v)) for k, v in seen.asDict().items()]

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.set()

    def table(self, spark: SparkSession, wait_s: float = 60.0) -> DataFrame:
        """``(run_id, batch, counter, n)`` of all batches reported; waits until the last query's end has come through."""
        self._ended.wait(wait_s)
        return spark.createDataFrame(list(self.rows), ROWS)
