"""Three-signal anomaly detector over a rolling per-symbol history (O-20 … O-27).

History = the previous ``history`` METRICS rows of the same symbol ordered by
window_end, excluding the current row (row-based: gaps between windows do not
count). A plain ``Window.partitionBy(symbol)`` would put every window of a hot
symbol into one task, so :func:`rolling_baseline` splits each symbol into
time chunks and hands every chunk a *halo* of the ``history`` rows that precede
it. The window then runs in parallel over (symbol, chunk); only the chunks'
tails (one row per chunk) are ordered per symbol.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import round_half_up, safe_ratio, severity_by_levels
from ..functions.timecols import as_interval, duration_seconds, scan_bound, time_bucket
from .windows import window_metrics

# Detector constants of the reference.
HISTORY_WINDOWS = 20
PRICE_Z_THRESHOLD = 3.0
VOLUME_MULTIPLIER = 5.0
VOLATILITY_MULTIPLIER = 3.0
# Severity ladders (strictly-greater-than levels): (CRITICAL above, WARNING above).
PRICE_SEVERITY = (4.0, 3.0)
VOLUME_SEVERITY = (10.0, 7.0)
VOLATILITY_SEVERITY = (6.0, 4.0)
# Alert message formats (Java formatter syntax, as the reference's JVM formatting).
PRICE_MESSAGE = "%s VWAP anomaly: Z-score=%.4f, current=$%.2f, baseline=$%.2f"
VOLUME_MESSAGE = "%s volume spike: %.1fx above average (current=%d, avg=%d)"
VOLATILITY_MESSAGE = "%s volatility spike: %.1fx above rolling average"

DEFAULT_CHUNK = "1 day"
# A look-back reads this many times the span of a gapless history before it.
REACH = 4
LONG_AGO = dt.datetime(1, 1, 2)
_VALUES = ("vwap", "volume", "volatility")


def _stats(w) -> list[Column]:
    """The statistics of the history frame ``w``; NULL where the history is empty."""
    return [F.count(F.lit(1)).over(w).alias("hist_n"),
            F.count("vwap").over(w).alias("price_n"),
            F.avg("vwap").over(w).alias("price_mean"),
            F.stddev_pop("vwap").over(w).alias("price_std"),
            F.avg("volume").over(w).alias("volume_mean"),
            F.avg("volatility").over(w).alias("volatility_mean")]


def _event_micros(df: DataFrame, col: str) -> Column:
    """Event time as epoch microseconds, without a time-zone shift for timestamp_ntz."""
    if df.schema[col].dataType.simpleString() == "timestamp_ntz":
        epoch = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(col))
    return F.unix_micros(F.col(col).cast("timestamp"))


def rolling_baseline(metrics: DataFrame, history: int = HISTORY_WINDOWS,
                     chunk: str | None = DEFAULT_CHUNK, order_col: str = "window_end",
                     reset_after: str | None = None) -> DataFrame:
    """Append rolling stats over the previous ``history`` rows per symbol.

    Adds hist_n (rows in history), price_n / price_mean / price_std (population,
    NULL vwaps skipped), volume_mean and volatility_mean. ``reset_after`` (e.g.
    "2 hours"): a gap longer than this between a symbol's consecutive windows
    empties its history, like the live store's expiry; it matches the stream's
    ``idle_ms``.

    Scale: a chunk's own rows and its halo, the ``history`` rows before it, meet
    in one window over (symbol, time chunk); halo rows are dropped after. Halos
    come from the chunks' tails, one row per chunk, and only those are ordered
    per symbol, so no task holds more than one chunk of a symbol. ``metrics`` is
    read twice, for rows and tails. ``chunk=None`` uses a single per-symbol
    window (cross-checks and small inputs only).
    """
    if history < 1:
        raise ValueError("history must be >= 1")
    order = [order_col, *_VALUES]  # a total order, so replayed windows rank alike everywhere
    if chunk is None:
        rows, key = metrics.withColumn("_halo", F.lit(False)), ["symbol"]
    else:
        rows, key = _with_halos(metrics, history, chunk, order_col, order), ["symbol", "_chunk"]
    if reset_after is not None:
        limit_us = int(duration_seconds(reset_after) * 1_000_000)
        w = Window.partitionBy(*key).orderBy(*order)
        gap = rows.withColumn("_t", _event_micros(rows, order_col))
        gap = gap.withColumn("_gap", F.coalesce(F.col("_t") - F.lag("_t").over(w) > limit_us, F.lit(False)).cast("int"))
        rows = gap.withColumn("_seg", F.sum("_gap").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        key = [*key, "_seg"]
    frame = Window.partitionBy(*key).orderBy(*order).rowsBetween(-history, -1)
    return rows.select(*metrics.columns, "_halo", *_stats(frame)).where(~F.col("_halo")).drop("_halo")


def _with_halos(metrics: DataFrame, history: int, chunk: str, order_col: str, order: list[str]) -> DataFrame:
    """``metrics`` with ``_chunk`` and ``_halo``: every chunk's rows and, marked, the ``history``
    rows of its symbol before it."""
    body = metrics.withColumn("_chunk", time_bucket(order_col, chunk))
    newest = Window.partitionBy("symbol", "_chunk").orderBy(*[F.col(c).desc() for c in order])
    # planned as a WindowGroupLimit: at most `history` rows per task and chunk are shuffled
    tails = (body.select("symbol", "_chunk", *order, F.row_number().over(newest).alias("_rank"))
             .where(F.col("_rank") <= history).groupBy("symbol", "_chunk")
             .agg(F.collect_list(F.struct(*order)).alias("_tail")))
    earlier = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(-history, -1)
    before = F.array_sort(F.flatten(F.collect_list("_tail").over(earlier)))
    halos = (tails.select("symbol", "_chunk", before.alias("_b"))
             .select("symbol", "_chunk", F.inline(F.slice(
                 "_b", F.greatest(F.lit(1), F.size("_b") - history + 1), F.lit(history)))))
    return (body.withColumn("_halo", F.lit(False))
            .unionByName(halos.withColumn("_halo", F.lit(True)), allowMissingColumns=True))


def _alert(symbol, alert_type, severity, z_score, threshold, current, baseline, message,
           window_start, window_end, detected_at) -> Column:
    return F.struct(
        symbol.alias("symbol"), F.lit(alert_type).alias("alert_type"), severity.alias("severity"),
        z_score.cast("double").alias("z_score"), F.lit(float(threshold)).alias("threshold"),
        current.cast("double").alias("current_value"), baseline.cast("double").alias("baseline_value"),
        message.alias("message"), window_start.alias("window_start"), window_end.alias("window_end"),
        detected_at.alias("detected_at"))


def price_signal(price_z: float = PRICE_Z_THRESHOLD, detected_at: Column | None = None) -> Column:
    """PRICE_ANOMALY struct or NULL. Needs rolling_baseline columns."""
    z = safe_ratio(F.col("vwap") - F.col("price_mean"), F.col("price_std"))
    fire = (F.col("price_n") > 0) & (F.col("price_std") > 0) & (F.abs(z) > F.lit(price_z))
    msg = F.format_string(PRICE_MESSAGE,
                          F.col("symbol"), z, F.col("vwap"), F.col("price_mean"))
    a = _alert(F.col("symbol"), "PRICE_ANOMALY", severity_by_levels(F.abs(z), *PRICE_SEVERITY),
               round_half_up(z, 4), price_z, F.col("vwap"), round_half_up(F.col("price_mean"), 6),
               msg, F.col("window_start"), F.col("window_end"), detected_at)
    return F.when(fire, a)


def volume_signal(volume_x: float = VOLUME_MULTIPLIER, detected_at: Column | None = None) -> Column:
    """VOLUME_SPIKE struct or NULL."""
    mean = F.col("volume_mean")
    ratio = safe_ratio(F.col("volume").cast("double"), mean)
    fire = (F.col("hist_n") > 0) & (mean > 0) & (F.col("volume") > mean * F.lit(volume_x))
    msg = F.format_string(VOLUME_MESSAGE,
                          F.col("symbol"), ratio, F.col("volume"), mean.cast("bigint"))
    a = _alert(F.col("symbol"), "VOLUME_SPIKE", severity_by_levels(ratio, *VOLUME_SEVERITY),
               round_half_up(ratio, 4), volume_x, F.col("volume").cast("double"),
               round_half_up(mean, 2), msg, F.col("window_start"), F.col("window_end"), detected_at)
    return F.when(fire, a)


def volatility_signal(volatility_x: float = VOLATILITY_MULTIPLIER,
                      detected_at: Column | None = None) -> Column:
    """VOLATILITY_SPIKE struct or NULL."""
    mean = F.col("volatility_mean")
    ratio = safe_ratio(F.col("volatility"), mean)
    fire = (F.col("hist_n") > 0) & (mean > 0) & (F.col("volatility") > mean * F.lit(volatility_x))
    msg = F.format_string(VOLATILITY_MESSAGE, F.col("symbol"), ratio)
    a = _alert(F.col("symbol"), "VOLATILITY_SPIKE", severity_by_levels(ratio, *VOLATILITY_SEVERITY),
               round_half_up(ratio, 4), volatility_x, round_half_up(F.col("volatility"), 8),
               round_half_up(mean, 8), msg, F.col("window_start"), F.col("window_end"), detected_at)
    return F.when(fire, a)


def alerts_from_baseline(baseline: DataFrame, price_z: float = PRICE_Z_THRESHOLD,
                         volume_x: float = VOLUME_MULTIPLIER,
                         volatility_x: float = VOLATILITY_MULTIPLIER,
                         detected_at: Column | str | None = None, min_history: int = 1) -> DataFrame:
    """0..3 alerts per METRICS+baseline row in one pass (explode of a filtered array)."""
    if isinstance(detected_at, str):
        detected_at = F.col(detected_at)
    det = detected_at if detected_at is not None else F.current_timestamp()
    sigs = F.array(price_signal(price_z, det), volume_signal(volume_x, det),
                   volatility_signal(volatility_x, det))
    rows = baseline
    if min_history > 1:
        rows = rows.filter(F.col("hist_n") >= min_history)
    # explode + filter keeps the stage inside whole-stage codegen (a lambda filter would not)
    return (rows.select(F.explode(sigs).alias("a"))
                .filter(F.col("a").isNotNull())
                .select("a.*"))


def detect_anomalies(metrics: DataFrame, history: int = HISTORY_WINDOWS,
                     price_z: float = PRICE_Z_THRESHOLD, volume_x: float = VOLUME_MULTIPLIER,
                     volatility_x: float = VOLATILITY_MULTIPLIER,
                     detected_at: Column | str | None = None, chunk: str | None = DEFAULT_CHUNK,
                     min_history: int = 1, reset_after: str | None = None) -> DataFrame:
    """METRICS -> ALERTS (symbol, alert_type, severity, z_score, threshold,
    current_value, baseline_value, message, window_start, window_end, detected_at).

    Signals are tested as soon as the history is non-empty (``min_history=1``,
    as in the reference); the price signal also needs a positive std-dev.
    ``detected_at`` defaults to the current timestamp.
    """
    base = rolling_baseline(metrics.select("symbol", "window_start", "window_end", *_VALUES),
                            history=history, chunk=chunk, reset_after=reset_after)
    return alerts_from_baseline(base, price_z, volume_x, volatility_x, detected_at, min_history)


def metrics_with_history(trades: DataFrame, since: Column, window: str, slide: str,
                         history: int = HISTORY_WINDOWS, reach: str | None = None) -> DataFrame:
    """The METRICS that :func:`detect_anomalies` needs for the windows that end at ``since`` or later:
    these and, for every symbol that has one, at least the ``history`` windows before them.

    Trades are read from ``reach`` (default: four times ``history`` slides) before ``since``. Symbols
    with a window since then but fewer than ``history`` in the reach have their older trades read
    too, however old, as a second branch. Where there are none, the upper bound of that branch's
    scan, a scalar subquery, lies before all trades, so statistics exclude every row group. Earlier
    windows may be missing or have a short history, so only alerts of windows that end at ``since``
    or later count.

    A symbol has at most one row a slide from the reach on and ``history`` older ones. Where the
    look-back is bounded, so are the rows of a symbol, and ``chunk=None`` spares the detector the
    second reading.
    """
    back = duration_seconds(reach) if reach is not None else REACH * history * duration_seconds(slide)
    start = scan_bound(trades, "event_time", since - as_interval(duration_seconds(window) + back))
    recent = (window_metrics(trades.where(F.col("event_time") >= start), window, slide)
              .where(F.col("window_start") >= start))
    before = F.col("window_end") < since
    short = (recent.groupBy("symbol").agg(F.count_if(before).alias("n"), F.count_if(~before).alias("due"))
             .where((F.col("n") < history) & (F.col("due") > 0)).select("symbol"))
    at = trades.schema["event_time"].dataType
    bound = short.agg(F.when(F.count(F.lit(1)) > 0, start + as_interval(window)).otherwise(F.lit(LONG_AGO)).cast(at))
    old = trades.where(F.col("event_time") < bound.scalar()).join(short, "symbol", "left_semi")
    newest = Window.partitionBy("symbol").orderBy(F.col("window_end").desc())
    older = (window_metrics(old, window, slide).where(F.col("window_start") < start)
             .withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= history).drop("_rank"))
    return recent.unionByName(older)
