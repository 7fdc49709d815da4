"""What streams report while they run, kept as a table: rows in, rows dropped as late, state.

Every micro-batch of every stream of the session becomes one small file named after the query
and the batch, so a batch that is replayed overwrites its own report.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query_id string, run_id string, name string, batch_id bigint, reported_at string, input_rows bigint, "
    "dropped_rows bigint, state_rows bigint, updated_rows bigint, watermark string, duration_ms bigint"
)


class ProgressTable(StreamingQueryListener):
    """A listener that writes progress; use it as a context so that it leaves the session again."""

    def __init__(self, spark: SparkSession, folder: str, also=None):
        """``also`` is called with each report, like a progress callback."""
        self.spark, self.folder, self.also = spark, folder, also
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        operators = p.stateOperators
        report = {
            "query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "reported_at": p.timestamp,
            "input_rows": p.numInputRows, "dropped_rows": sum(o.numRowsDroppedByWatermark for o in operators),
            "state_rows": sum(o.numRowsTotal for o in operators), "updated_rows": sum(o.numRowsUpdated for o in operators),
            "watermark": p.eventTime.get("watermark"), "duration_ms": p.batchDuration,
        }
        self._write(f"{self.folder}/{p.id}/{p.batchId:09d}.json", json.dumps(report))
        if self.also is not None:
            self.also(report)

    def _write(self, path: str, text: str) -> None:
        context = self.spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def wait(self, run: str, seconds: float = 60) -> None:
        """Reports come after the fact: wait until those of a terminated run are all written."""
        if not self._end_of(str(run)).wait(seconds):
            raise TimeoutError(f"no end of run {run} was reported")

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(self.folder)
