"""What each micro-batch of a stream read, wrote and dropped, as a table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

REPORT = (
    "query string, run_id string, batch_id bigint, started string, rows_in bigint, rows_out bigint, "
    "rows_late bigint, state_rows bigint, duration_ms bigint"
)
_OUT = "rows_out"


def counted(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (a stream's result) with its row count observed under ``name``,
    which is also the name its report goes by."""
    return rows.observe(name, F.count(F.lit(1)).alias(_OUT))


class StreamReports(StreamingQueryListener):
    """Collects a row per micro-batch of every ``counted`` stream of the session.

    ``rows_late`` is what stateful operators refused because of the watermark;
    aggregates count after combining within a task, so there it counts groups.
    ``flush`` appends what has come in since and forgets it, so memory is
    bounded by the time between two calls.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.add(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        done = event.progress
        for name, metrics in done.observedMetrics.items():
            operators = done.stateOperators
            self._rows.append((
                name, str(done.runId), done.batchId, done.timestamp, done.numInputRows, metrics[_OUT],
                sum(o.numRowsDroppedByWatermark for o in operators), sum(o.numRowsTotal for o in operators), done.batchDuration,
            ))

    def wait_for(self, run_id: str, seconds: float = 60) -> bool:
        """Events come a little after the batches. True when all of an ended query are in."""
        until = time.monotonic() + seconds
        while str(run_id) not in self._ended and time.monotonic() < until:
            time.sleep(0.05)
        return str(run_id) in self._ended

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append the collected rows to the table; returns how many."""
        rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("append").parquet(path)
        return len(rows)
