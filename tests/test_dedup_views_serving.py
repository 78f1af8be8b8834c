"""De-dup (O-29/30), views (O-33…O-40), serving validation (O-43…O-49)."""
import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from helpers import ts
from tidemark.operators import dedup, sinks, views
from tidemark.plans import serving as S
from tidemark.schemas import ALERTS


def alert_rows(spark, rows):
    """rows: (symbol, type, severity, window_start_seconds, z)"""
    data = [(s, t, sev, float(z), 3.0, 1.0, 1.0, "m", ts(w), ts(w + 60), ts(w + 60))
            for (s, t, sev, w, z) in rows]
    return spark.createDataFrame(data, ALERTS)


def test_dedup_key_matches_python(spark):
    df = alert_rows(spark, [("AAPL", "PRICE_ANOMALY", "WARNING", 125, 3.5)])
    key = dedup.with_dedup_key(df).first().dedup_key
    ms = int((ts(125) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    raw = f"AAPL:PRICE_ANOMALY:{ms // 300000}"
    assert key == "alert:dedup:" + hashlib.md5(raw.encode()).hexdigest()


def test_first_alert_per_bucket_wins(spark):
    # two PRICE alerts of AAPL in one 5-minute bucket (different severities), one in the next
    df = alert_rows(spark, [("AAPL", "PRICE_ANOMALY", "CRITICAL", 60, 4.5),
                            ("AAPL", "PRICE_ANOMALY", "WARNING", 30, 3.5),
                            ("AAPL", "PRICE_ANOMALY", "WARNING", 330, 3.2),
                            ("AAPL", "VOLUME_SPIKE", "INFO", 60, 5.5)])
    out = dedup.dedup_alerts(df).orderBy("window_start", "alert_type").collect()
    assert [(r.alert_type, r.severity, r.z_score) for r in out] == [
        ("PRICE_ANOMALY", "WARNING", 3.5), ("VOLUME_SPIKE", "INFO", 5.5),
        ("PRICE_ANOMALY", "WARNING", 3.2)]


def test_dedup_skewed_key_is_aggregated_not_collected(spark):
    df = spark.range(20000).select(
        F.lit("HOT").alias("symbol"), F.lit("PRICE_ANOMALY").alias("alert_type"),
        F.lit("INFO").alias("severity"), F.col("id").cast("double").alias("z_score"),
        F.lit(3.0).alias("threshold"), F.lit(1.0).alias("current_value"),
        F.lit(1.0).alias("baseline_value"), F.lit("m").alias("message"),
        (F.lit(ts(0)) + F.make_dt_interval(secs=F.col("id") % 200)).alias("window_start"),
        F.lit(ts(600)).alias("window_end"), F.lit(ts(600)).alias("detected_at"))
    out = dedup.dedup_alerts(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "collect_list" not in plan
    r = out.collect()
    assert len(r) == 1 and r[0].z_score == 0.0


def metric_table(spark, rows):
    """rows: (symbol, window_end_s, high, low, vwap)"""
    data = [(s, ts(e - 60), ts(e), float(v), 0.1, 50.0, 10, 2, float(h), float(l), ts(e + 40))
            for (s, e, h, l, v) in rows]
    return spark.createDataFrame(data, "symbol string, window_start timestamp, window_end timestamp, "
                                 "vwap double, volatility double, rsi double, volume bigint, "
                                 "trade_count bigint, high double, low double, created_at timestamp")


def test_top_movers_golden(spark):
    # range-% of the latest window per symbol: AAPL 2.5, GOOGL 1.8, TSLA 5.2; n=2
    m = metric_table(spark, [("AAPL", 60, 102.5, 100.0, 101.0), ("GOOGL", 60, 101.8, 100.0, 101.0),
                             ("TSLA", 60, 105.2, 100.0, 101.0), ("TSLA", 0, 200.0, 100.0, 150.0)])
    got = [(r.symbol, r.price_change_pct) for r in S.top_movers(m, n=2).collect()]
    assert got == [("TSLA", 5.2), ("AAPL", 2.5)]


def test_latest_state_ttl_and_latest_symbol(spark):
    m = metric_table(spark, [("AAPL", 60, 1, 1, 1.0), ("AAPL", 120, 2, 2, 2.0), ("MSFT", 0, 3, 3, 3.0)])
    st = views.latest_state(m, as_of=F.lit(ts(150)), ttl="60 seconds")
    assert [(r.symbol, r.vwap) for r in st.collect()] == [("AAPL", 2.0)]
    row = S.latest(st, "aapl").first()
    assert row.symbol == "AAPL" and row.window_end == int((ts(120) - dt.datetime(1970, 1, 1))
                                                         .total_seconds() * 1000)
    assert S.latest(st, "msft").count() == 0


def test_metric_history_limit_and_plan(spark):
    m = metric_table(spark, [("A", 30 * i, 1, 1, float(i)) for i in range(1, 200)])
    h = views.metric_history(m, n=120)
    assert h.count() == 120 and h.agg(F.min("vwap")).first()[0] == 80.0
    assert "WindowGroupLimit" in h._jdf.queryExecution().executedPlan().toString()


def test_history_range_inclusive_desc(spark):
    m = metric_table(spark, [("AAPL", 60 * i, 1, 1, float(i)) for i in range(1, 11)])
    out = S.history(m, "aapl", start=F.lit(ts(120)), end=F.lit(ts(360)), limit=3).collect()
    assert [r.vwap for r in out] == [7.0, 6.0, 5.0]  # window_start = (i-1) min, inclusive bounds


@pytest.mark.parametrize("kw", [dict(limit=0), dict(limit=1001)])
def test_history_limit_validation(spark, kw):
    m = metric_table(spark, [("A", 60, 1, 1, 1.0)])
    with pytest.raises(ValueError):
        S.history(m, "A", **kw)


def test_alert_filter_validation_and_defaults(spark):
    a = sinks.audit_rows(alert_rows(spark, [("AAPL", "PRICE_ANOMALY", "WARNING", 0, 3.5)]))
    with pytest.raises(ValueError):
        S.alerts(a, severity="bogus")
    with pytest.raises(ValueError):
        S.alerts(a, alert_type="nope")
    with pytest.raises(ValueError):
        S.alerts(a, hours=169)
    d = S.alert_row_defaults(a.withColumn("current_value", F.lit(0.0))
                              .withColumn("z_score", F.lit(None).cast("double"))).first()
    assert d.current_value is None and d.z_score == 0.0
    got = S.alerts(a, symbol="aapl", severity="warning", as_of=F.lit(ts(3600))).collect()
    assert len(got) == 1 and got[0].acknowledged is False


def test_alert_summary_view_strict_window(spark):
    a = alert_rows(spark, [("A", "PRICE_ANOMALY", "WARNING", 0, 3.0),
                           ("A", "PRICE_ANOMALY", "WARNING", 3600, 5.0)])
    # detected_at = window_start + 60 s; as_of - 24h == first detection -> excluded (strict >)
    out = views.alert_summary_view(a, as_of=F.lit(ts(60) + dt.timedelta(hours=24))).collect()
    assert len(out) == 1 and out[0].alert_count == 1 and out[0].avg_z_score == 5.0


def test_keyed_json_and_annotations(spark):
    a = alert_rows(spark, [("AAPL", "VOLUME_SPIKE", "INFO", 0, 5.5)])
    kv = sinks.to_keyed_json(a).first()
    assert kv.key == "AAPL" and '"alert_type":"VOLUME_SPIKE"' in kv.value
    ann = sinks.alert_annotations(a.withColumn("message", F.lit(None).cast("string"))).first()
    assert ann.tags == ["VOLUME_SPIKE", "INFO", "AAPL"] and ann.text == "Anomaly detected"
    assert ann.dashboardUID == ""


def test_history_member_packing(spark):
    m = metric_table(spark, [("A", 60, 102.0, 100.5, 101.1)])
    got = m.select(views.history_member(m).alias("h")).first().h
    assert got == "101.1|0.1|50.0|10|2|102.0|100.5"
