"""Live views in the state store (O-33, O-34, O-35): per symbol the latest metrics row and the last
``HISTORY_SIZE`` windows, kept in keyed state by one streaming query and read back through Spark's
``statestore`` source, so a reader sees the last committed batch without any table of snapshots.

Entries expire in event time: a symbol whose newest window lies ``latest_ttl`` behind the watermark
leaves the latest state and the ranking; one without a window for longer than ``history_ttl`` loses its
history, whether or not it comes back, however batches fall. State per symbol is bounded; a restart from the checkpoint goes on with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.timecols import duration_seconds
from ..operators.views import HISTORY_SIZE, HISTORY_TTL, LATEST_TTL, range_pct
from ..operators.windows import DEFAULT_SLIDE, DEFAULT_WATERMARK, DEFAULT_WINDOW, window_metrics
from ..schemas import METRIC_COLUMNS, METRICS
from ..session import export_package, scratch_path
from .app import DEFAULT_TRIGGER

#: State rows: METRICS without the key, times in microseconds.
_TIMES = ("window_start", "window_end")
_ENTRY = T.StructType([T.StructField(f.name, T.LongType() if f.name in _TIMES else f.dataType)
                       for f in METRICS.fields if f.name != "symbol"])
_END = _ENTRY.fieldNames().index("window_end")


class LiveState(StatefulProcessor):
    """Keeps ``latest`` (value state) and ``history`` (list state) of a symbol; emits nothing."""

    def __init__(self, latest_ms: int, history_ms: int, size: int = HISTORY_SIZE):
        self.latest_ms, self.history_ms, self.size = latest_ms, history_ms, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", _ENTRY)
        self.history = handle.getListState("history", _ENTRY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        for c in _TIMES:
            pdf[c] = pdf[c].astype("datetime64[us]").astype("int64")
        new = [tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r)
               for r in pdf[_ENTRY.fieldNames()].itertuples(index=False)]
        old = list(map(tuple, self.history.get())) if self.history.exists() else []
        # a window that comes again replaces its entry
        entries = sorted({r[_END]: r for r in [*old, *new]}.values(), key=lambda r: r[_END])[-self.size:]
        for i in range(len(entries) - 1, 0, -1):  # expired before the symbol came back, within this batch
            if entries[i][_END] - entries[i - 1][_END] > self.history_ms * 1000:
                entries = entries[i:]
                break
        self.history.put(entries)
        if not self.latest.exists() or self.latest.get()[_END] <= entries[-1][_END]:
            self.latest.update(entries[-1])
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        for ttl in {self.latest_ms, self.history_ms}:
            self.handle.registerTimer(entries[-1][_END] // 1000 + ttl)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if self.latest.exists() and at >= self.latest.get()[_END] // 1000 + self.latest_ms:
            self.latest.clear()
        entries = list(self.history.get()) if self.history.exists() else []
        if entries and at >= entries[-1][_END] // 1000 + self.history_ms:
            self.history.clear()
        return iter([])

    def close(self) -> None:
        pass


def start_live_views(trades_stream: DataFrame, checkpoint: str | None = None, window: str = DEFAULT_WINDOW,
                     slide: str = DEFAULT_SLIDE, watermark: str = DEFAULT_WATERMARK, latest_ttl: str = LATEST_TTL,
                     history_ttl: str = HISTORY_TTL, size: int = HISTORY_SIZE, trigger: dict | None = None,
                     query_name: str = "live-views") -> StreamingQuery:
    """Keep the live views of a TRADES stream in the state of the query's ``checkpoint``."""
    if not trades_stream.isStreaming:
        raise ValueError("start_live_views needs a streaming DataFrame")
    spark = export_package(trades_stream.sparkSession)
    metrics = window_metrics(trades_stream, window, slide, watermark).select(*METRIC_COLUMNS)
    state = LiveState(int(duration_seconds(latest_ttl) * 1000), int(duration_seconds(history_ttl) * 1000), size)
    kept = metrics.groupBy("symbol").transformWithStateInPandas(
        state, "symbol string, window_end timestamp", "append", "eventTime", eventTimeColumnName="window_end")
    return (kept.writeStream.queryName(query_name).format("noop").outputMode("append")
            .option("checkpointLocation", checkpoint or scratch_path(spark, "streams", query_name))
            .trigger(**(trigger or DEFAULT_TRIGGER)).start())


def _state(spark: SparkSession, checkpoint: str, name: str, entry: str) -> DataFrame:
    operators = (spark.read.format("state-metadata").load(checkpoint)
                 .where(F.lower("operatorName").startswith("transformwithstate")).select("operatorId").distinct())
    operator = operators.head()[0]  # a query has few operators
    rows = (spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
            .option("stateVarName", name).load())
    times = {c: F.timestamp_micros(F.col(f"{entry}.{c}")) for c in _TIMES}
    return rows.select(*[F.col("key.symbol").alias("symbol") if c == "symbol" else
                         times.get(c, F.col(f"{entry}.{c}")).alias(c) for c in METRIC_COLUMNS])


def live_latest(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The latest METRICS row of every symbol that has not expired."""
    return _state(spark, checkpoint, "latest", "value")


def live_history(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The last windows of every symbol that has not expired."""
    return _state(spark, checkpoint, "history", "list_element")


def live_top_movers(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Top-mover scores of the symbols that have not expired."""
    return live_latest(spark, checkpoint).select("symbol", range_pct().alias("price_change_pct"))
