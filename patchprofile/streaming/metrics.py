"""Progress of a stream as a table: one record per micro-batch that read rows."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from patchprofile.sources.fs import put_text

INPUT = "input"  # the name the stream's rows are observed under

PROGRESS_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("trigger_ms", T.LongType()),
    T.StructField("started_at", T.StringType()),
])


def observed(stream: DataFrame) -> DataFrame:
    """The stream with its rows counted where they are read."""
    return stream.observe(INPUT, F.count(F.lit(1)).alias("rows"))


class ProgressLog(StreamingQueryListener):
    """Writes each progress report under ``path`` when Spark sends it, one small JSON object per micro-batch.

    Row counts are the observed ones where the stream was ``observed``, else the source's. A micro-batch that is run again
    after a restart replaces its record. Reports come on another thread, after the batch: ``finish`` waits for the last one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._over: dict[str, threading.Event] = {}

    def _event(self, query_id) -> threading.Event:
        return self._over.setdefault(str(query_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(event.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(INPUT)
        rows = p.numInputRows if seen is None else seen["rows"]
        if not rows:
            return
        record = {"batch_id": p.batchId, "input_rows": int(rows), "trigger_ms": dict(p.durationMs).get("triggerExecution"), "started_at": p.timestamp}
        put_text(self.spark, f"{self.path}/batch={p.batchId}/progress.json", json.dumps(record))

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()

    def finish(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait until ``query`` has ended and its last report is written."""
        query.awaitTermination()
        if not self._event(query.runId).wait(timeout):
            raise TimeoutError("the stream's last progress report did not come")

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).json(f"{self.path}/batch=*")
