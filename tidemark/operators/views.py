"""Latest-state, bounded history, ranking and summary views (O-33 … O-40).

All per-symbol "latest" views use ``max_by`` aggregates (map-side partial
combine, one partial row per task and symbol) and bounded per-symbol history
uses ``row_number() <= n`` which Spark plans as a WindowGroupLimit that
pre-limits before the shuffle. No view collects an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import round_half_up
from ..functions.timecols import as_interval, epoch_millis, resolve_as_of
from ..schemas import METRIC_COLUMNS

# TTLs / sizes of the reference's live views.
LATEST_TTL = "60 seconds"
HISTORY_SIZE = 120
HISTORY_TTL = "1 hour"
SUMMARY_HOURS = 24


def latest_per_key(df: DataFrame, key: str | list[str] = "symbol", order_col: str = "window_start",
                   columns: list[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_col`` (DISTINCT ON ... ORDER BY desc)."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in (columns or df.columns) if c not in keys]
    # one max_by per column keeps fixed-width buffers, hence hash aggregates without a sort
    return df.groupBy(*keys).agg(*[F.max_by(c, order_col).alias(c) for c in cols if c != order_col],
                                 F.max(order_col).alias(order_col)).select(*keys, *cols)


def latest_metrics(metrics_table: DataFrame) -> DataFrame:
    """Materialised ``latest_metrics`` view (O-38): newest window per symbol incl. created_at."""
    cols = [c for c in METRIC_COLUMNS if c in metrics_table.columns]
    if "created_at" in metrics_table.columns:
        cols.append("created_at")
    return latest_per_key(metrics_table.select(*cols), "symbol", "window_start")


def latest_state(metrics: DataFrame, as_of=None, ttl: str | None = LATEST_TTL,
                 updated_at: Column | str | None = "created_at") -> DataFrame:
    """Keyed latest state per symbol (O-33): METRICS + updated_at (epoch ms).

    ``updated_at`` is the write time of the row (``created_at`` of the table or
    the current time). Entries older than ``ttl`` relative to ``as_of`` are
    treated as expired, as the live cache's TTL would have removed them.
    """
    cols = [c for c in METRIC_COLUMNS if c in metrics.columns]
    if isinstance(updated_at, str) and updated_at in metrics.columns:
        upd = epoch_millis(updated_at)
    elif isinstance(updated_at, Column):
        upd = epoch_millis(updated_at)
    else:
        upd = F.unix_millis(F.current_timestamp())
    latest = latest_per_key(metrics.select(*cols, upd.alias("updated_at")), "symbol", "window_end")
    if ttl is None:
        return latest
    now = resolve_as_of(as_of, metrics, "window_end")
    return latest.filter(F.col("updated_at") >= epoch_millis(now - as_interval(ttl)))


def range_pct(low: Column | str = "low", high: Column | str = "high") -> Column:
    """Top-mover score (high-low)/low·100, 0 when low <= 0."""
    lo = F.col(low) if isinstance(low, str) else low
    hi = F.col(high) if isinstance(high, str) else high
    return F.when(lo > 0, (hi - lo) / lo * F.lit(100.0)).otherwise(F.lit(0.0))


def top_mover_scores(metrics: DataFrame) -> DataFrame:
    """(symbol, price_change_pct): score of each symbol's latest window (last write wins)."""
    latest = latest_per_key(metrics.select("symbol", "window_end", "high", "low"), "symbol", "window_end")
    return latest.select("symbol", range_pct().alias("price_change_pct"))


def metric_history(metrics: DataFrame, n: int = HISTORY_SIZE, order_col: str = "window_end") -> DataFrame:
    """Last ``n`` windows per symbol (O-34) with their rank (1 = newest).

    ``row_number() <= n`` is planned as WindowGroupLimit (partial limit before
    the shuffle, final after), so a hot symbol ships at most n rows per task.
    """
    w = Window.partitionBy("symbol").orderBy(F.col(order_col).desc(), *[
        F.col(c).desc() for c in ("window_start", "volume", "vwap") if c in metrics.columns and c != order_col])
    return (metrics.withColumn("rank", F.row_number().over(w))
                   .filter(F.col("rank") <= n))


def history_member(df: DataFrame) -> Column:
    """The packed history member 'vwap|volatility|rsi|volume|trade_count|high|low'."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("0.0")) for c in
             ("vwap", "volatility", "rsi")] + [F.col(c).cast("string") for c in
             ("volume", "trade_count")] + [F.col(c).cast("string") for c in ("high", "low")]
    return F.concat_ws("|", *parts)


def alert_summary_view(alerts: DataFrame, as_of=None, hours: int = SUMMARY_HOURS) -> DataFrame:
    """Materialised ``alert_summary`` (O-39): per (symbol, severity, alert_type) count,
    last detection and mean z-score over ``detected_at > as_of - hours`` (strict)."""
    now = resolve_as_of(as_of, alerts, "detected_at")
    return (alerts.filter(F.col("detected_at") > now - as_interval(f"{hours} hours"))
                  .groupBy("symbol", "severity", "alert_type")
                  .agg(F.count(F.lit(1)).alias("alert_count"),
                       F.max("detected_at").alias("last_detected"),
                       round_half_up(F.avg("z_score"), 8).alias("avg_z_score")))


def unacknowledged_alerts(alerts_table: DataFrame) -> DataFrame:
    """Alerts not yet acknowledged (O-40), newest first."""
    return (alerts_table.filter(F.col("acknowledged") == F.lit(False))
                        .orderBy(F.col("detected_at").desc(), "symbol", "alert_type"))
