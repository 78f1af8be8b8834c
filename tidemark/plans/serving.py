"""Serving queries (O-43 … O-49) as validated DataFrame functions.

Each takes the persisted table(s) and returns a lazy DataFrame; top-k results
are ``orderBy(...).limit(k)`` which Spark plans as TakeOrderedAndProject
(per-task top-k, then a k-row merge) — never a full sort. Every ordering ends in
unique columns so a limit is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import round_half_up
from ..functions.timecols import as_interval, epoch_millis, resolve_as_of, time_range_filter
from ..operators.views import top_mover_scores
from ..schemas import ALERT_TYPES, SEVERITIES


def _check_range(name: str, value: int, lo: int, hi: int) -> int:
    if not isinstance(value, int) or not lo <= value <= hi:
        raise ValueError(f"{name} must be an integer in [{lo}, {hi}], got {value!r}")
    return value


def latest(latest_state_df: DataFrame, symbol: str) -> DataFrame:
    """Latest metrics of one symbol (O-43); empty when absent or expired.

    Missing numerics read as 0 (rsi as 50); window bounds are epoch ms.
    """
    sym = symbol.upper()
    d = latest_state_df.filter(F.col("symbol") == F.lit(sym))
    zero = F.lit(0.0)
    return d.select(
        F.lit(sym).alias("symbol"),
        F.coalesce(F.col("vwap"), zero).alias("vwap"),
        F.coalesce(F.col("volatility"), zero).alias("volatility"),
        F.coalesce(F.col("rsi"), F.lit(50.0)).alias("rsi"),
        F.coalesce(F.col("volume"), F.lit(0).cast("bigint")).alias("volume"),
        F.coalesce(F.col("trade_count"), F.lit(0).cast("bigint")).alias("trade_count"),
        F.coalesce(F.col("high"), zero).alias("high"),
        F.coalesce(F.col("low"), zero).alias("low"),
        epoch_millis("window_start").alias("window_start"),
        epoch_millis("window_end").alias("window_end"),
        F.col("updated_at"),
    )


def history(metrics_table: DataFrame, symbol: str, start=None, end=None, limit: int = 100,
            as_of=None) -> DataFrame:
    """Metric history of one symbol (O-44): ``start <= window_start <= end``, newest first.

    Defaults: ``end = as_of``, ``start = end - 1 hour``; ``limit`` in [1, 1000].
    """
    _check_range("limit", limit, 1, 1000)
    hi = resolve_as_of(as_of if end is None else end, metrics_table, "window_end")
    lo = (hi - as_interval("1 hour")) if start is None else resolve_as_of(start)
    cols = ["symbol", "window_start", "window_end", "vwap", "volatility", "rsi", "volume",
            "trade_count", "high", "low"]
    d = time_range_filter(metrics_table.filter(F.col("symbol") == F.lit(symbol.upper())),
                          "window_start", lo, hi)
    return d.select(*cols).orderBy(F.col("window_start").desc()).limit(limit)


def top_movers(metrics: DataFrame, n: int = 10) -> DataFrame:
    """Top-N symbols by range-% of their latest window (O-45); ties by symbol descending."""
    _check_range("n", n, 1, 50)
    scores = top_mover_scores(metrics)
    return (scores.select("symbol", round_half_up(F.col("price_change_pct"), 4).alias("price_change_pct"))
                  .orderBy(F.col("price_change_pct").desc(), F.col("symbol").desc())
                  .limit(n))


def _alert_filters(alerts_df: DataFrame, symbol, severity, alert_type, hours: int, as_of):
    _check_range("hours", hours, 1, 168)
    now = resolve_as_of(as_of, alerts_df, "detected_at")
    cond = F.lit(True)
    if symbol:
        cond = cond & (F.col("symbol") == F.lit(symbol.upper()))
    if severity:
        if severity.upper() not in SEVERITIES:
            raise ValueError("severity must be one of: " + ", ".join(SEVERITIES))
        cond = cond & (F.col("severity") == F.lit(severity.upper()))
    if alert_type:
        if alert_type.upper() not in ALERT_TYPES:
            raise ValueError("alert_type must be one of: " + ", ".join(ALERT_TYPES))
        cond = cond & (F.col("alert_type") == F.lit(alert_type.upper()))
    return time_range_filter(alerts_df.filter(cond), "detected_at", now - as_interval(f"{hours} hours"))


def alert_row_defaults(df: DataFrame) -> DataFrame:
    """Response defaults (O-47): z_score/threshold NULL->0.0; current/baseline NULL or 0 -> NULL."""
    return df.withColumns({
        "z_score": F.coalesce(F.col("z_score"), F.lit(0.0)),
        "threshold": F.coalesce(F.col("threshold"), F.lit(0.0)),
        "current_value": F.nullif(F.col("current_value"), F.lit(0.0)),
        "baseline_value": F.nullif(F.col("baseline_value"), F.lit(0.0)),
    })


def alerts(alerts_table: DataFrame, symbol: str | None = None, severity: str | None = None,
           alert_type: str | None = None, hours: int = 24, limit: int = 50, as_of=None,
           with_message: bool = True) -> DataFrame:
    """Filtered recent alerts (O-46), newest first, optional predicates ANDed."""
    _check_range("limit", limit, 1, 500)
    d = _alert_filters(alerts_table, symbol, severity, alert_type, hours, as_of)
    cols = ["id", "symbol", "alert_type", "severity", "z_score", "threshold", "current_value",
            "baseline_value", "message", "window_start", "window_end", "detected_at", "acknowledged"]
    out = [c for c in cols if c in d.columns and (with_message or c != "message")]
    return (alert_row_defaults(d).select(*out)
             .orderBy(F.col("detected_at").desc(), "symbol", "alert_type", F.col("window_start").desc())
             .limit(limit))


def alert_summary(alerts_table: DataFrame, hours: int = 24, as_of=None) -> DataFrame:
    """Alert counts per (symbol, severity, alert_type) over the last ``hours`` (O-48)."""
    d = _alert_filters(alerts_table, None, None, None, hours, as_of)
    return (d.groupBy("symbol", "severity", "alert_type")
             .agg(F.count(F.lit(1)).alias("alert_count"), F.max("detected_at").alias("last_detected"))
             .orderBy(F.col("alert_count").desc(), "symbol", "severity", "alert_type"))


def recent_metrics(metrics_table: DataFrame, as_of=None, lookback: str = "1 hour",
                   limit: int = 100) -> DataFrame:
    """All symbols' windows of the last hour, newest first, 5 columns (O-49)."""
    now = resolve_as_of(as_of, metrics_table, "window_end")
    return (time_range_filter(metrics_table, "window_start", now - as_interval(lookback))
                         .select("symbol", "window_start", "vwap", "volatility", "volume")
                         .orderBy(F.col("window_start").desc(), "symbol")
                         .limit(limit))
