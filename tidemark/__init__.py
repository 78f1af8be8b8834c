"""tidemark — Spark-native tick analytics.

Sliding event-time window metrics, a rolling three-signal anomaly detector,
alert de-duplication, latest-state / history / ranking views and the serving and
dashboard queries over them, written as plain DataFrame functions that run
unchanged in batch and in Structured Streaming.
"""

from .operators.anomaly import alerts_from_baseline, detect_anomalies, rolling_baseline
from .operators.dedup import dedup_alerts, with_dedup_key
from .operators.sinks import alert_annotations, audit_rows, read_table, to_keyed_json, write_metrics_table
from .operators.views import (alert_summary_view, latest_metrics, latest_state, metric_history,
                              top_mover_scores, unacknowledged_alerts)
from .operators.windows import window_metrics
from .plans import dashboards, serving
from .sources import (clean_trades, decode_framed_avro, normalize_quotes, parse_alert_json,
                      read_alerts, read_trades)
from .streaming.app import read_latest, start_market_stream, stop_when_idle

__version__ = "0.1.0"

__all__ = [
    "window_metrics", "rolling_baseline", "detect_anomalies", "alerts_from_baseline",
    "dedup_alerts", "with_dedup_key", "latest_state", "latest_metrics", "metric_history",
    "top_mover_scores", "alert_summary_view", "unacknowledged_alerts", "to_keyed_json",
    "write_metrics_table", "read_table", "audit_rows", "alert_annotations", "serving", "dashboards",
    "read_trades", "clean_trades", "decode_framed_avro", "read_alerts", "parse_alert_json",
    "normalize_quotes", "start_market_stream", "read_latest", "stop_when_idle",
]
