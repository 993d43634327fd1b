"""What each micro-batch took in and dropped, kept as a table."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query_id string, query_name string, batch_id long, operator_id int, operator string, input_rows long, watermark string, "
    "state_rows long, updated_rows long, dropped_rows long"
)


class BatchReports(StreamingQueryListener):
    """Writes one row per micro-batch and stateful operator; a stateless query gives one row with the operator ``none``.

    ``dropped_rows`` are those that came to the operator after the watermark had passed them. Operators that take
    rows one by one (deduplication) count rows of the stream, windowed aggregations count what is left of them after the partial
    aggregation. A batch has a folder of its own by query and batch id, so a replayed one takes the place of its first report.
    Each batch gives a few rows on the driver, whatever its size.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._running: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        common = (str(p.id), p.name, p.batchId)
        watermark = p.eventTime.get("watermark")
        rows = [
            (*common, i, op.operatorName, p.numInputRows, watermark, op.numRowsTotal, op.numRowsUpdated, op.numRowsDroppedByWatermark)
            for i, op in enumerate(p.stateOperators)
        ]
        rows = rows or [(*common, 0, "none", p.numInputRows, watermark, 0, 0, 0)]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{p.id}/{p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._running.discard(str(event.runId))
            self._changed.notify_all()

    def settled(self, seconds: float = 60) -> bool:
        """Wait until the reports of all queries that have ended are written; events arrive a little after the batches."""
        with self._changed:
            return self._changed.wait_for(lambda: not self._running, seconds)

    def table(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.path)


@contextmanager
def reported(spark: SparkSession, path: str) -> Iterator[BatchReports]:
    """Reports of all queries that are started and end within the block."""
    listener = BatchReports(spark, path)
    spark.streams.addListener(listener)
    try:
        yield listener
        if not listener.settled():
            raise TimeoutError("a query of the block is still running, or its last report has not arrived")
    finally:
        spark.streams.removeListener(listener)
