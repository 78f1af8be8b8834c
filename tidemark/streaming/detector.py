"""Stateful rolling history for streams (O-28) and streaming de-dup (O-30).

Spark keeps, per symbol, the last ``history`` METRICS values in a RocksDB-backed
value state (``transformWithStateInPandas``). For every closed window the
processor emits the METRICS row plus the same baseline statistics the batch
:func:`tidemark.operators.anomaly.rolling_baseline` computes, on arrays and in
the same order of summation, so batch and stream produce the same alerts. Signals,
severities and messages are then ordinary Spark expressions
(:func:`alerts_from_baseline`). Idle symbols are dropped by an event-time timer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.anomaly import HISTORY_WINDOWS
from ..operators.dedup import DEDUP_TTL_SECONDS, with_dedup_key
from ..schemas import METRICS

# Fixed value: the reference lets rolling history expire 2 hours after the last write.
# Opt-in here (``idle_ms=IDLE_EXPIRY_MS``): by default history is row-based across
# gaps, exactly like the batch baseline; state stays bounded (``history`` values per
# symbol) either way.
IDLE_EXPIRY_MS = 2 * 3600 * 1000

BASELINE_FIELDS = [
    T.StructField("hist_n", T.LongType()),
    T.StructField("price_n", T.LongType()),
    T.StructField("price_mean", T.DoubleType()),
    T.StructField("price_std", T.DoubleType()),
    T.StructField("volume_mean", T.DoubleType()),
    T.StructField("volatility_mean", T.DoubleType()),
]
BASELINE_OUT = T.StructType(list(METRICS.fields) + BASELINE_FIELDS)

_VALUES = ("vwap", "volume", "volatility")
_STATE = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in _VALUES]
                      + [T.StructField("end_ms", T.ArrayType(T.LongType()))])


def _frames(x: np.ndarray, first: np.ndarray, history: int) -> np.ndarray:
    """Row i: the ``history`` values before i, oldest first; NaN where there is none or it lies
    before ``first[i]``, the start of the row's segment."""
    n = len(x)
    padded = np.concatenate([np.full(history, np.nan), x])
    frames = np.lib.stride_tricks.sliding_window_view(padded, history)[:n].copy()
    frames[np.arange(n)[:, None] - history + np.arange(history)[None, :] < first[:, None]] = np.nan
    return frames


def _moments(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and population std of each row's values, updated in order as Spark does."""
    n, total, mean, m2 = (np.zeros(len(frames)) for _ in range(4))
    for x in frames.T:
        has = ~np.isnan(x)
        v = np.where(has, x, 0.0)
        total += v
        n += has
        step = np.where(has, (v - mean) / np.maximum(n, 1), 0.0)
        m2 += np.where(has, (v - mean) * (v - mean - step), 0.0)
        mean += step
    none = n == 0
    with np.errstate(invalid="ignore", divide="ignore"):
        return n, np.where(none, np.nan, total / n), np.where(none, np.nan, np.sqrt(m2 / n))


class RollingHistory(StatefulProcessor):
    """Per-symbol bounded history -> METRICS rows + rolling baseline stats."""

    def __init__(self, history: int = HISTORY_WINDOWS, idle_ms: int | None = None):
        self.history = history
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("history", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["window_end", *_VALUES], kind="stable",
                                                                   na_position="first", ignore_index=True)
        old = [np.array(x, np.float64) for x in self.state.get()] if self.state.exists() else [np.zeros(0)] * 4
        ends = np.concatenate([old[3], pdf["window_end"].astype("datetime64[ms]").astype("int64")]).astype(np.int64)
        first = np.zeros(len(ends), np.int64)
        if self.idle_ms:  # history expires during a gap (event time)
            gap = np.diff(ends, prepend=ends[:1]) > self.idle_ms
            first = np.maximum.accumulate(np.where(gap, np.arange(len(ends)), 0))
        columns = [np.concatenate([o, pdf[c].astype("float64")]) for o, c in zip(old, _VALUES)]
        new = slice(len(old[3]), None)
        (price_n, price, std), (_, volume, _), (_, volatility, _) = (
            _moments(_frames(x, first, self.history)[new]) for x in columns)
        hist_n = np.minimum(np.arange(len(ends)) - first, self.history)[new]
        keep = slice(max(0, len(ends) - self.history), None)
        self.state.update(tuple([None if math.isnan(v) else float(v) for v in x[keep]] for x in columns)
                          + (ends[keep].tolist(),))
        if self.idle_ms:
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t)
            self.handle.registerTimer(int(ends.max()) + self.idle_ms)
        stats = pd.DataFrame(dict(zip([f.name for f in BASELINE_FIELDS], (
            hist_n.astype("int64"), price_n.astype("int64"), price, std, volume, volatility))))
        yield pd.concat([pdf, stats], axis=1)[[f.name for f in BASELINE_OUT.fields]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # a symbol silent for idle_ms: drop its state (a returning symbol is also reset
        # by the gap check in handleInputRows, whichever runs first)
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_baseline(metrics_stream: DataFrame, history: int = HISTORY_WINDOWS,
                    idle_ms: int | None = None) -> DataFrame:
    """METRICS stream -> METRICS + baseline stream (event-time: window_end)."""
    return (metrics_stream.groupBy("symbol")
            .transformWithStateInPandas(RollingHistory(history, idle_ms), BASELINE_OUT, "append",
                                        "eventTime", eventTimeColumnName="window_end"))


def dedup_stream(alerts_stream: DataFrame, ttl_seconds: int = DEDUP_TTL_SECONDS) -> DataFrame:
    """Streaming first-wins de-dup on the watermark inherited from the detector.

    Do not re-apply ``withWatermark`` here: the detector's event-time output
    already carries it (a second watermark would judge every row late).
    """
    return with_dedup_key(alerts_stream, ttl_seconds).dropDuplicatesWithinWatermark(["dedup_key"])


#: How long the stream remembers a de-duplication key, in milliseconds.
REMEMBER_MS = 24 * 3600 * 1000
_TIMES = ("window_start", "window_end", "detected_at")
_SEEN = T.StructType([T.StructField("seen", T.BooleanType())])


class FirstAlert(StatefulProcessor):
    """The first alert of a key, by its times and then its other values; none while the key is remembered."""

    def __init__(self, columns: list[str], times: list[str], order: list[str], remember_ms: int, passes: str | None):
        self.columns, self.times, self.order, self.remember_ms, self.passes = columns, times, order, remember_ms, passes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", _SEEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, first, arrived = self.seen.exists(), None, 0
        for pdf in rows:
            if pdf.empty:
                continue
            arrived = max(arrived, int(pdf["arrived_ms"].max()))
            pdf = pdf[self.columns].astype({c: "Int64" for c in self.times})
            if self.passes:
                other = pdf[self.passes].notna()
                if other.any():
                    yield pdf[other]
                    pdf = pdf[~other]
            if not known and len(pdf):
                both = pdf if first is None else pd.concat([first, pdf])
                first = both.sort_values(self.order, kind="stable", na_position="first").head(1)
        if first is not None:
            self.seen.update((True,))
            self.handle.registerTimer(arrived + self.remember_ms)
            yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def first_alerts(alerts_stream: DataFrame, ttl_seconds: int = DEDUP_TTL_SECONDS, remember_ms: int = REMEMBER_MS,
                 passes: str | None = None) -> DataFrame:
    """Streaming first-wins de-dup in keyed state, with ``dedup_key`` as the first column.

    Its watermark is the time at which batches start, which the checkpoint logs and a replay repeats, so a
    first alert is never too late whatever its windows. A key is held until a timer ``remember_ms``
    after its first alert: state is bounded by the alerts of that time, and a batch costs a lookup for each
    of its keys, however long the stream runs. A repeat that comes after the key has expired counts
    as new. Rows where the column ``passes`` is not null are no alerts and pass unchanged.
    """
    columns = ["dedup_key", *alerts_stream.columns]
    named = with_dedup_key(alerts_stream, ttl_seconds)
    if passes:  # spread: they have no key of their own
        spread = F.concat(F.lit("other:"), F.pmod(F.xxhash64(passes), F.lit(1024)).cast("string"))
        named = named.withColumn("dedup_key", F.when(F.col(passes).isNull(), F.col("dedup_key")).otherwise(spread))
    # times as numbers, for Python sees no time zone; names that start with a letter, which its rows need
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    plain = named.select(*[(F.unix_micros(c) if c in _TIMES else F.col(c)).alias(n) for c, n in names.items()])
    timed = (plain.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "1 second")
             .withColumn("arrived_ms", F.unix_millis("arrived")))
    times = [names[c] for c in _TIMES]
    order = times + [names[c] for c in alerts_stream.columns if c not in _TIMES and c != passes]
    out = timed.groupBy(names["dedup_key"]).transformWithStateInPandas(
        FirstAlert(list(names.values()), times, order, remember_ms, names.get(passes)), plain.schema, "append", "eventTime")
    return out.select(*[(F.timestamp_micros(n) if c in _TIMES else F.col(n)).alias(c) for c, n in names.items()])
