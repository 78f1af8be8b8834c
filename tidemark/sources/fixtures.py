"""Driver test tables -> pipeline inputs.

The ``events`` table stands in for the trade stream: it only supplies rows in
the TRADES schema; every metric, baseline and alert is computed by the library
functions from those rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timecols import as_interval, duration_seconds, scan_bound
from ..operators.anomaly import detect_anomalies, metrics_with_history
from ..operators.dedup import DEDUP_TTL_SECONDS, dedup_alerts
from ..operators.sinks import audit_rows
from ..operators.windows import window_metrics
from .trades import clean_trades

# Fixture timing. Events are minutes apart, so metric queries use the
# reference's 1 min / 30 s windows and the detector runs on 1 h / 30 min windows
# (enough history per symbol to fire all three signals). Table rows are "written"
# 40 s after their window closes.
METRIC_WINDOW = ("1 minute", "30 seconds")
ANOMALY_WINDOW = ("1 hour", "30 minutes")
WRITE_LAG = "40 seconds"


def trades_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> TRADES.

    symbol = upper(event_type) (tickers are upper-case; the serving layer
    upper-cases its symbol argument), price = value, volume = props.k,
    event_time = ts, exchange = 'X' || user_id % 5, trade_id = event_id.
    """
    raw = events.select(
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"),
        F.col("ts").alias("event_time"),
        F.concat(F.lit("X"), (F.col("user_id") % 5).cast("string")).alias("exchange"),
        F.col("event_id").cast("string").alias("trade_id"),
    )
    return clean_trades(raw, event_time="event_time")


class Fixture:
    """Lazy DataFrames over one scale-factor folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        # driver timestamps are naive UTC wall-clock values
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def trades(self) -> DataFrame:
        return trades_from_events(self.table("events"))

    def metrics(self, window: str = METRIC_WINDOW[0], slide: str = METRIC_WINDOW[1],
                since: Column | None = None) -> DataFrame:
        """METRICS; with ``since`` only of trades from then on, which are all that windows starting
        then or later hold: the bound reaches the scan, below the windows."""
        trades = self.trades
        if since is not None:
            trades = trades.where(F.col("event_time") >= scan_bound(trades, "event_time", since))
        return window_metrics(trades, window, slide)

    def metrics_table(self, window: str = METRIC_WINDOW[0], slide: str = METRIC_WINDOW[1],
                      since: Column | None = None) -> DataFrame:
        """METRICS as persisted: + created_at (window_end + write lag)."""
        m = self.metrics(window, slide, since)
        return m.withColumn("created_at", F.col("window_end") + as_interval(WRITE_LAG))

    @cached_property
    def anomaly_table(self) -> DataFrame:
        """The detector's METRICS (1 h / 30 min), lazy like every other table here."""
        return self.metrics(*ANOMALY_WINDOW)

    def anomaly_metrics(self) -> DataFrame:
        return self.anomaly_table

    def alerts(self) -> DataFrame:
        """Detector output with detected_at = window_end (deterministic)."""
        return detect_anomalies(self.anomaly_table, detected_at=F.col("window_end"))

    def alerts_table(self, since: Column | None = None) -> DataFrame:
        """Alerts as persisted by the audit sink: de-duplicated, acknowledged=false,
        created_at = window_end + write lag. With ``since`` those detected from then on, from the
        trades that their windows, histories and de-duplication buckets need."""
        if since is None:
            deduped = dedup_alerts(self.alerts())
        else:
            first = since - as_interval(DEDUP_TTL_SECONDS)
            metrics = metrics_with_history(self.trades, first, *ANOMALY_WINDOW)
            alerts = detect_anomalies(metrics, detected_at=F.col("window_end"), chunk=None)
            deduped = dedup_alerts(alerts.where(F.col("window_end") >= first)).where(F.col("detected_at") >= since)
        return audit_rows(deduped, created_at=F.col("window_end") + as_interval(WRITE_LAG))

    def as_of(self, window: str = METRIC_WINDOW[0], slide: str = METRIC_WINDOW[1]) -> Column:
        """NOW() of the fixture: the newest window_end, from the newest trade's time alone (scalar
        subquery over one column)."""
        w, s = int(duration_seconds(window)), int(duration_seconds(slide))
        newest = F.unix_seconds(F.max("event_time").cast("timestamp"))
        end = F.timestamp_seconds(F.floor(newest / s) * s + w).cast(self.trades.schema["event_time"].dataType)
        return self.trades.select(end).scalar()

    def anomaly_as_of(self) -> Column:
        return self.as_of(*ANOMALY_WINDOW)


# Fixed value: a far-future trade appended after the landed files advances the
# watermark past every real window so the last windows close (append mode).
SENTINEL_TIME = "2100-01-01 00:00:00"
SENTINEL_SYMBOL = "~SENTINEL"


def raw_trades(fx: Fixture) -> DataFrame:
    """The fixture's trades as RAW_TRADE rows."""
    return fx.trades.select("symbol", "price", "volume", F.col("event_time").cast("timestamp").alias("timestamp"),
                            "exchange", "trade_id")


def time_slices(rows: DataFrame, n: int) -> list[DataFrame]:
    """``rows`` cut into ``n`` slices of equal time, oldest first."""
    lo, hi = rows.select(F.min("timestamp"), F.max("timestamp")).first()
    edges = [lo + (hi - lo) / n * i for i in range(n)]
    at = F.col("timestamp")
    return [rows.where((at >= F.lit(a)) & (at < F.lit(b))) if b else rows.where(at >= F.lit(a))
            for a, b in zip(edges, [*edges[1:], None])]


def sentinel(fx: Fixture, time: Column | None = None) -> DataFrame:
    """One trade that closes all earlier windows."""
    at = F.to_timestamp(F.lit(SENTINEL_TIME)) if time is None else time
    return fx.spark.range(1).select(F.lit(SENTINEL_SYMBOL).alias("symbol"), F.lit(1.0).alias("price"), F.lit(1).cast("bigint").alias("volume"),
                                    at.alias("timestamp"), F.lit("X0").alias("exchange"), F.lit("sentinel").alias("trade_id"))


def dealt(rows: DataFrame, files: int) -> DataFrame:
    """``rows`` dealt to ``files`` files by symbol and day, each in the order of the trades: sums of
    doubles depend on their order in the last bit."""
    if files == 1:
        return rows.coalesce(1)
    return (rows.repartition(files, "symbol", F.to_date("timestamp"))
            .sortWithinPartitions(F.col("trade_id").try_cast("bigint")))


def land_raw_trades(fx: Fixture, out_dir: str, n_files: int = 6, last: bool = True, files: int = 1) -> None:
    """Write the fixture's trades as RAW_TRADE Parquet files, a job per slice of time, so that
    modification times follow event time (a file stream reads the oldest first); every slice is
    ``files`` files, written in parallel. ``last`` appends the sentinel."""
    for rows in time_slices(raw_trades(fx), n_files):
        dealt(rows, files).write.mode("append").parquet(out_dir)
    if last:
        sentinel(fx).write.mode("append").parquet(out_dir)
