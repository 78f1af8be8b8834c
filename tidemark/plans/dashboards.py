"""Dashboard panel queries (O-50 … O-68).

Panel display labels ('Pipeline Status', 'Avg Trades/Window', ...) are returned as
snake_case column names.

``time filter`` = ``start <= c <= end`` (default: the hour before ``as_of``);
"last N minutes" panels use ``c >= as_of - N``. Global aggregates return one
row even on empty input (NULL/0), as SQL does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.timecols import as_interval, epoch_seconds_between, resolve_as_of, time_range_filter


def _range(df: DataFrame, col: str, start, end, as_of, lookback: str, ref_col: str) -> DataFrame:
    hi = resolve_as_of(as_of if end is None else end, df, ref_col)
    lo = (hi - as_interval(lookback)) if start is None else resolve_as_of(start)
    return time_range_filter(df, col, lo, hi)


def _since(df: DataFrame, col: str, lookback: str, as_of, ref_col: str) -> DataFrame:
    now = resolve_as_of(as_of, df, ref_col)
    return time_range_filter(df, col, now - as_interval(lookback))


def vwap_series(metrics, start=None, end=None, as_of=None, lookback="1 hour"):
    """O-50: (time, symbol, value=vwap) ordered by time."""
    d = _range(metrics, "window_start", start, end, as_of, lookback, "window_end")
    return d.select(F.col("window_start").alias("time"), "symbol", F.col("vwap").alias("value")) \
            .orderBy("time", "symbol")


def volume_series(metrics, start=None, end=None, as_of=None, lookback="1 hour"):
    """O-51: (time, symbol, value=volume)."""
    d = _range(metrics, "window_start", start, end, as_of, lookback, "window_end")
    return d.select(F.col("window_start").alias("time"), "symbol", F.col("volume").alias("value")) \
            .orderBy("time", "symbol")


def avg_volatility(metrics, as_of=None, lookback="5 minutes"):
    """O-52: AVG(volatility) of windows starting in the last 5 minutes (NULL when none)."""
    return _since(metrics, "window_start", lookback, as_of, "window_end") \
        .agg(F.avg("volatility").alias("value"))


def alert_count(alerts, as_of=None, lookback="1 hour"):
    """O-53: number of alerts detected in the last hour."""
    return _since(alerts, "detected_at", lookback, as_of, "detected_at") \
        .agg(F.count(F.lit(1)).alias("value"))


def alerts_by_severity(alerts, as_of=None, lookback="24 hours"):
    """O-54: alerts per severity, last 24 h."""
    return _since(alerts, "detected_at", lookback, as_of, "detected_at") \
        .groupBy("severity").agg(F.count(F.lit(1)).alias("count"))


def total_trades(metrics, as_of=None, lookback="1 hour"):
    """O-55: SUM(trade_count) of windows starting in the last hour."""
    return _since(metrics, "window_start", lookback, as_of, "window_end") \
        .agg(F.sum("trade_count").alias("value"))


def recent_alerts(alerts, as_of=None, lookback="1 hour", limit=20, with_message=True):
    """O-56: the 20 most recent alerts of the last hour."""
    cols = ["detected_at", "symbol", "alert_type", "severity", "z_score"] + (["message"] if with_message else [])
    return _since(alerts, "detected_at", lookback, as_of, "detected_at") \
        .select(*cols, "window_start").orderBy(F.col("detected_at").desc(), "symbol", "alert_type",
                                               F.col("window_start").desc()).limit(limit).select(*cols)


def symbols(metrics):
    """O-57: distinct symbols, sorted."""
    return metrics.select("symbol").distinct().orderBy("symbol")


def symbol_price(metrics, symbol, start=None, end=None, as_of=None, lookback="1 hour"):
    """O-58: one symbol's (time, VWAP, High, Low) series."""
    d = _range(metrics.filter(F.col("symbol") == F.lit(symbol)), "window_start", start, end, as_of,
               lookback, "window_end")
    return d.select(F.col("window_start").alias("time"), F.col("vwap"),
                    F.col("high"), F.col("low")).orderBy("time")


def symbol_current(metrics, symbol):
    """O-59: one symbol's current VWAP and RSI (its newest window; one row or none)."""
    return (metrics.filter(F.col("symbol") == F.lit(symbol))
                   .orderBy(F.col("window_start").desc()).limit(1)
                   .select("vwap", "rsi"))


def symbol_series(metrics, symbol, start=None, end=None, as_of=None, lookback="1 hour"):
    """O-60: one symbol's volatility / rsi / volume series."""
    d = _range(metrics.filter(F.col("symbol") == F.lit(symbol)), "window_start", start, end, as_of,
               lookback, "window_end")
    return d.select(F.col("window_start").alias("time"), "volatility", "rsi", "volume").orderBy("time")


def symbol_alerts(alerts, symbol, start=None, end=None, as_of=None, lookback="1 hour", limit=10,
                  with_message=True):
    """O-61: one symbol's 10 latest alerts within the time filter."""
    d = _range(alerts.filter(F.col("symbol") == F.lit(symbol)), "detected_at", start, end, as_of,
               lookback, "detected_at")
    cols = ["detected_at", "alert_type", "severity", "z_score"] + (["message"] if with_message else [])
    return d.select(*cols, "window_start").orderBy(
        F.col("detected_at").desc(), "alert_type", F.col("window_start").desc()).limit(limit).select(*cols)


def stream_status(metrics, as_of=None, lookback="2 minutes"):
    """O-62: 'Active' when any window started in the last 2 minutes, else 'Stalled'."""
    n = _since(metrics, "window_start", lookback, as_of, "window_end").agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.when(F.col("n") > 0, F.lit("Active")).otherwise(F.lit("Stalled"))
                    .alias("pipeline_status"))


def events_processed(metrics, start=None, end=None, as_of=None, lookback="1 hour"):
    """O-63: SUM(trade_count) per window_start."""
    d = _range(metrics, "window_start", start, end, as_of, lookback, "window_end")
    return d.groupBy(F.col("window_start").alias("time")) \
            .agg(F.sum("trade_count").alias("events_processed")).orderBy("time")


def active_symbols(metrics, as_of=None, lookback="5 minutes"):
    """O-64: exact COUNT(DISTINCT symbol) over the last 5 minutes."""
    return _since(metrics, "window_start", lookback, as_of, "window_end") \
        .agg(F.count_distinct("symbol").alias("active_symbols"))


def avg_window_size(metrics, as_of=None, lookback="5 minutes"):
    """O-65: ROUND(AVG(trade_count)) over the last 5 minutes."""
    return _since(metrics, "window_start", lookback, as_of, "window_end") \
        .agg(F.round(F.avg("trade_count")).alias("avg_trades_per_window"))


def alert_rate(alerts, start=None, end=None, as_of=None, lookback="1 hour"):
    """O-66: alerts per minute and severity."""
    d = _range(alerts, "detected_at", start, end, as_of, lookback, "detected_at")
    minute = F.date_trunc("minute", "detected_at").cast(alerts.schema["detected_at"].dataType)
    return d.groupBy(minute.alias("time"), "severity") \
            .agg(F.count(F.lit(1)).alias("count")).orderBy("time", "severity")


def processing_lag(metrics_table, start=None, end=None, as_of=None, lookback="1 hour"):
    """O-67: seconds between a window's end and its row being written."""
    d = _range(metrics_table, "window_start", start, end, as_of, lookback, "window_end")
    return d.select(F.col("window_start").alias("time"),
                    epoch_seconds_between(F.col("created_at"), F.col("window_end"))
                    .alias("processing_lag_s")).orderBy("time")


def freshness(metrics_table, as_of=None):
    """O-68: seconds since the newest row was written."""
    now = resolve_as_of(as_of, metrics_table, "window_end")
    last = metrics_table.agg(F.max("created_at").alias("m"))
    return last.select(epoch_seconds_between(now, F.col("m")).alias("staleness_s"))
