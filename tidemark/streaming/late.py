"""Rows that the watermark drops, counted batch by batch beside the sink."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "name string, run_id string, batch_id long, n_rows long, n_late long"


class LateRows(StreamingQueryListener):
    """Stores one small JSON file per batch of the query ``name`` under ``path``: its input rows and the
    rows its stateful operators dropped. Files are named by batch, so a replayed batch is stored once.

    An operator counts the rows that reach it: behind ``dropDuplicates`` on the raw events these are
    events, behind a windowed aggregate the partial sums of a task."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self.error: Exception | None = None

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if progress.name != self.name:
            return
        row = {
            "name": progress.name, "run_id": str(progress.runId), "batch_id": progress.batchId, "n_rows": progress.numInputRows,
            "n_late": sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
        }
        try:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch-{progress.batchId}.json")
            out = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True)
            try:
                out.write(bytearray(json.dumps(row).encode() + b"\n"))
            finally:
                out.close()
        except Exception as error:  # raised by ``wait``: an error here would only be logged
            self.error = error

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the ended ``query``'s batches are stored: events come in order, its end last."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of stream {self.name} was not reported in {seconds} s")
        if self.error is not None:
            raise RuntimeError(f"late rows of stream {self.name} were not stored") from self.error

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(self.path)
