"""Dashboard panels (O-50…O-68) on small hand-made tables."""

from pyspark.sql import functions as F

from helpers import ts
from tidemark.plans import dashboards as D
from tidemark.schemas import ALERTS


def metric_table(spark, rows):
    """rows: (symbol, window_start_s, vwap, volatility, trade_count)"""
    data = [(s, ts(w), ts(w + 60), float(v), float(vol), 50.0, 10, int(n), v + 1.0, v - 1.0, ts(w + 100))
            for (s, w, v, vol, n) in rows]
    return spark.createDataFrame(data, "symbol string, window_start timestamp, window_end timestamp, "
                                 "vwap double, volatility double, rsi double, volume bigint, "
                                 "trade_count bigint, high double, low double, created_at timestamp")


def test_empty_lookbacks_return_one_row(spark):
    m = metric_table(spark, [("A", 0, 10.0, 0.5, 3)])
    later = F.lit(ts(3600 * 5))
    assert D.avg_volatility(m, as_of=later).first().value is None
    assert D.total_trades(m, as_of=later).first().value is None
    assert D.active_symbols(m, as_of=later).first().active_symbols == 0
    assert D.stream_status(m, as_of=later).first().pipeline_status == "Stalled"
    assert D.stream_status(m, as_of=F.lit(ts(60))).first().pipeline_status == "Active"


def test_window_panels(spark):
    m = metric_table(spark, [("A", 0, 10.0, 0.2, 3), ("B", 0, 20.0, 0.4, 5), ("A", 60, 11.0, 0.6, 4)])
    now = F.lit(ts(120))
    assert abs(D.avg_volatility(m, as_of=now).first().value - 0.4) < 1e-12
    assert D.total_trades(m, as_of=now).first().value == 12
    assert D.avg_window_size(m, as_of=now).first().avg_trades_per_window == 4.0
    assert D.active_symbols(m, as_of=now).first().active_symbols == 2
    ev = [(r.time, r.events_processed) for r in D.events_processed(m, as_of=now).collect()]
    assert ev == [(ts(0), 8), (ts(60), 4)]
    assert [r.symbol for r in D.symbols(m).collect()] == ["A", "B"]
    cur = D.symbol_current(m, "A").first()
    assert (cur.vwap, cur.rsi) == (11.0, 50.0)
    lag = D.processing_lag(m, as_of=now).collect()
    assert {r.processing_lag_s for r in lag} == {40.0}
    assert D.freshness(m, as_of=F.lit(ts(400))).first().staleness_s == 400 - 160


def test_alert_rate_per_minute(spark):
    rows = [("A", "PRICE_ANOMALY", sev, 3.5, 3.0, 1.0, 1.0, "m", ts(0), ts(60), ts(d))
            for sev, d in (("WARNING", 5), ("WARNING", 50), ("CRITICAL", 70))]
    a = spark.createDataFrame(rows, ALERTS)
    got = [(r.time, r.severity, r["count"]) for r in D.alert_rate(a, as_of=F.lit(ts(120))).collect()]
    assert got == [(ts(0), "WARNING", 2), (ts(60), "CRITICAL", 1)]
    sev = {r.severity: r["count"] for r in D.alerts_by_severity(a, as_of=F.lit(ts(120))).collect()}
    assert sev == {"WARNING": 2, "CRITICAL": 1}
    rec = D.recent_alerts(a, as_of=F.lit(ts(120)), limit=2).collect()
    assert [r.detected_at for r in rec] == [ts(70), ts(50)] and rec[0].message == "m"
    assert D.alert_count(a, as_of=F.lit(ts(3600 + 60))).first().value == 1
