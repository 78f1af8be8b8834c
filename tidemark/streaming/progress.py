"""Pipeline metric rows from streaming progress (O-42): throughput, batch duration,
rows dropped by the watermark — the rows the reference's pipeline_metrics table declares."""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..schemas import PIPELINE_METRICS


def _metrics_of(p: dict) -> list[tuple]:
    labels = {"query": str(p.get("name") or p.get("id")), "batch_id": str(p.get("batchId"))}
    ts = dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).replace(tzinfo=None)
    dropped = sum(int(s.get("numRowsDroppedByWatermark", 0) or 0) for s in p.get("stateOperators", []))
    state_rows = sum(int(s.get("numRowsTotal", 0) or 0) for s in p.get("stateOperators", []))
    vals = {
        "input_rows": p.get("numInputRows"),
        "input_rows_per_second": p.get("inputRowsPerSecond"),
        "processed_rows_per_second": p.get("processedRowsPerSecond"),
        "batch_duration_ms": (p.get("durationMs") or {}).get("triggerExecution"),
        "rows_dropped_by_watermark": dropped,
        "state_rows": state_rows,
    }
    return [(k, float(v), labels, ts) for k, v in vals.items() if v is not None]


def progress_rows(spark: SparkSession, progresses) -> DataFrame:
    """StreamingQueryProgress objects (or their JSON) -> PIPELINE_METRICS rows."""
    rows = []
    for p in progresses:
        d = json.loads(p.json) if hasattr(p, "json") else (json.loads(p) if isinstance(p, str) else p)
        rows.extend(_metrics_of(d))
    return spark.createDataFrame(rows, PIPELINE_METRICS)


class ProgressCollector(StreamingQueryListener):
    """Listener that holds progress events (one small record per micro-batch) until :meth:`drain`
    hands them over, e.g. to :func:`append_progress`. Beyond ``most`` the oldest go and ``lost``
    counts them; with ``spark`` and ``path`` the listener appends its events to that table itself,
    every ``most`` of them and when a query ends, and loses none."""

    def __init__(self, most: int = 10_000, spark: SparkSession | None = None, path: str | None = None):
        self._lock = threading.Lock()
        self.most, self.lost, self.spark, self.path = most, 0, spark, path
        self.events: deque[str] = deque()
        self.ended: set[str] = set()

    def drain(self) -> list[str]:
        """The events held so far, which are then forgotten."""
        with self._lock:
            out = list(self.events)
            self.events.clear()
        return out

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        with self._lock:
            self.events.append(event.progress.json)
            full = len(self.events) > self.most
            if full and not self.path:
                self.events.popleft()
                self.lost += 1
        if full and self.path:
            self.flush()

    def flush(self) -> int:
        """Append the events held to the table; they stay held if that fails."""
        with self._lock:
            held = list(self.events)
        n = append_progress(self.spark, held, self.path) if held else 0
        with self._lock:
            for _ in held:
                self.events.popleft()
        return n

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if self.path:
            self.flush()
        self.ended.add(str(event.id))

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return progress_rows(spark, list(self.events))


def append_progress(spark: SparkSession, progresses, path: str) -> int:
    """Append pipeline metric rows to a Parquet table partitioned by date of recording."""
    from pyspark.sql import functions as F
    rows = progress_rows(spark, progresses)
    n = rows.count()
    if n:
        (rows.withColumn("dt", F.to_date("recorded_at")).write.mode("append")
         .partitionBy("dt").parquet(path))
    return n
