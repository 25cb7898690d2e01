"""Run records of streams: one for each batch, and one for the end of each run."""

from __future__ import annotations

import threading
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tristrata.operators.audit import CANCELLED, FAILED, RUN_SCHEMA, SUCCESS, run_record

#: The batch number of a run's last record.
END = -1
STREAM_SCHEMA = f"{RUN_SCHEMA}, run_id STRING, batch_id BIGINT"


class StreamAudit(StreamingQueryListener):
    """Writes a record for each batch of the session's named queries, and for each end of a run.

    A record lies in a directory of its run and batch, so that one written again replaces itself.
    Queries without a name are not recorded. The end's record sums the batches up: it is Success
    where the query came to its end, Failed with the error, or Cancelled where ``cancel`` stopped
    it. Attach it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.runs: dict[str, dict] = {}
        self.cancelled: set[str] = set()
        self.ended = threading.Condition()
        self.done: set[str] = set()

    def onQueryStarted(self, event) -> None:
        if event.name:
            self.runs[str(event.runId)] = {"name": event.name, "start": _time(event.timestamp), "records": 0}

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        run = self.runs.get(str(batch.runId))
        if run is None:
            return
        start = _time(batch.timestamp)
        took = batch.durationMs.get("triggerExecution", 0)
        run["records"] += batch.numInputRows
        rates = {k: float(v) for k, v in (("rows_per_second", batch.processedRowsPerSecond),) if v}
        self._write(
            str(batch.runId), batch.batchId, run["name"], SUCCESS, start,
            start + timedelta(milliseconds=took), batch.numInputRows, None, rates,
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run_id = str(event.runId)
        run = self.runs.pop(run_id, None)
        if run is not None:
            status = FAILED if event.exception else CANCELLED if run_id in self.cancelled else SUCCESS
            now = datetime.now(timezone.utc)
            self._write(run_id, END, run["name"], status, run["start"], now, run["records"], event.exception, {})
        with self.ended:
            self.done.add(run_id)
            self.ended.notify_all()

    def _write(self, run_id: str, batch: int, *record) -> None:
        place = f"{self.path}/run_id={run_id}/batch_id={batch}"
        run_record(self.spark, *record).write.mode("overwrite").parquet(place)

    def cancel(self, query: StreamingQuery) -> None:
        """Stop a query so that its record says so."""
        self.cancelled.add(str(query.runId))
        query.stop()

    def wait(self, *queries: StreamingQuery, seconds: float = 60) -> None:
        """Until the ends of these queries are on record; Spark reports them a little later."""
        limit = time.monotonic() + seconds
        wanted = {str(query.runId) for query in queries}
        with self.ended:
            while not wanted <= self.done:
                if not self.ended.wait(limit - time.monotonic()):
                    raise TimeoutError(f"no end on record for {sorted(wanted - self.done)}")


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records, with their run and batch; the end of a run has batch ``END``."""
    return spark.read.schema(STREAM_SCHEMA).parquet(path)
