"""Sources and sinks: alert JSON decode, framed-Avro header, quotes, partitioned layout."""
import tempfile


from helpers import ts
from tidemark.operators.sinks import read_table, to_keyed_json, write_metrics_table
from tidemark.schemas import ALERTS
from tidemark.sources.alerts import parse_alert_json
from tidemark.sources.quotes import normalize_quotes
from tidemark.sources.trades import strip_wire_header


def test_alert_json_roundtrip_and_corrupt_rows(spark):
    rows = [("AAPL", "PRICE_ANOMALY", "WARNING", 3.5, 3.0, 180.0, 175.0, "msg", ts(0), ts(60), ts(60))]
    a = spark.createDataFrame(rows, ALERTS)
    msgs = to_keyed_json(a).select("value")
    extra = spark.createDataFrame(
        [("not json",), ('{"symbol": "MSFT"}',),
         ('{"symbol":"TSLA","alert_type":"VOLUME_SPIKE","severity":"INFO","z_score":5.5,'
          '"window_start":1704103200000,"window_end":1704103260000,"detected_at":1704103260000}',)],
        "value string")
    good, bad = parse_alert_json(msgs.unionByName(extra))
    g = {r.symbol: r for r in good.collect()}
    assert set(g) == {"AAPL", "TSLA"}
    assert g["AAPL"].z_score == 3.5 and g["AAPL"].window_start == ts(0)
    assert g["TSLA"].window_start == ts(0) and g["TSLA"].current_value is None  # epoch-ms form
    assert bad.count() == 2


def test_wire_header_strip(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07payload"),)], "value binary")
    assert bytes(df.select(strip_wire_header("value").alias("v")).first().v) == b"payload"


def test_quote_normalisation(spark):
    df = spark.createDataFrame([
        ("AAPL", '{"Global Quote": {"05. price": "175.50", "06. volume": "1000"}}'),
        ("MSFT", '{"Global Quote": {}}'),
        ("GOOG", '{"Global Quote": {"05. price": "0", "06. volume": "5"}}'),
        ("TSLA", '{"Global Quote": {"05. price": "210.25"}}'),
        ("X", '{"Information": "rate limited"}'),
    ], "symbol string, payload string")
    out = {r.symbol: r for r in normalize_quotes(df).collect()}
    assert set(out) == {"AAPL", "TSLA"}
    assert (out["AAPL"].price, out["AAPL"].volume, out["AAPL"].exchange) == (175.5, 1000, "UNKNOWN")
    assert out["TSLA"].volume == 0 and len(out["TSLA"].trade_id) == 36


def test_partitioned_layout_prunes_dates(spark):
    path = tempfile.mkdtemp(prefix="tidemark-layout-") + "/metrics"
    rows = [("A", ts(86400 * d), ts(86400 * d + 60), 1.0) for d in range(5)]
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp, window_end timestamp, vwap double")
    write_metrics_table(df, path, mode="overwrite")
    q = read_table(spark, path, start=ts(86400 * 2), end=ts(86400 * 3 + 100))
    assert q.count() == 2
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters" in plan


def _zigzag(n: int) -> bytes:
    z = (n << 1) ^ (n >> 63)
    out = bytearray()
    while True:
        b = z & 0x7F
        z >>= 7
        if z:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _encode_trade(symbol, price, volume, ts_ms, exchange, trade_id) -> bytes:
    import struct
    s = lambda x: _zigzag(len(x.encode())) + x.encode()
    body = s(symbol) + struct.pack("<d", price) + _zigzag(volume) + _zigzag(ts_ms) + s(exchange) + s(trade_id)
    return b"\x00\x00\x00\x00\x2a" + body   # magic byte + schema id 42


def test_framed_avro_needs_the_module(spark):
    """spark-avro is not on this classpath: decoding says so instead of taking another path."""
    import pytest

    from tidemark.sources.trades import decode_framed_avro
    kafka = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x2a\x08AAPL"), ts(0))],
                                  "value binary, timestamp timestamp")
    with pytest.raises(Exception, match="(?i)avro"):
        decode_framed_avro(kafka).collect()


def test_partition_dates_are_utc_in_any_session_zone(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.operators.sinks import read_table, write_metrics_table
    zone, found = spark.conf.get("spark.sql.session.timeZone"), set()
    try:
        rows = spark.range(6).select(F.lit("A").alias("symbol"),
                                     F.timestamp_seconds(F.lit(1704067200 - 3 * 3600) + F.col("id") * 3600).alias("window_start"))
        write_metrics_table(rows, str(tmp_path / "m"), mode="overwrite")
        for z in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            lo, hi = (F.timestamp_seconds(F.lit(1704067200 + d * 3600)) for d in (-3, 2))
            found.add(read_table(spark, str(tmp_path / "m"), start=lo, end=hi).count())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == {6}


def test_metric_row_round_trip(spark):
    """Hand golden: one metrics row written to the table layout and read back unchanged."""
    from tidemark.schemas import METRICS
    row = ("TEST", ts(0), ts(60), 100.50, 0.0234, 55.0, 50000, 150, 101.00, 99.50)
    df = spark.createDataFrame([row], METRICS)
    path = tempfile.mkdtemp(prefix="tidemark-rt-") + "/metrics"
    write_metrics_table(df, path, mode="overwrite")
    back = read_table(spark, path, start=ts(0), end=ts(0)).drop("dt").collect()
    assert [tuple(r) for r in back] == [row]


def test_alert_row_round_trip(spark):
    """Hand golden: an alert persisted by the audit sink reads back with acknowledged=false."""
    from tidemark.operators.sinks import audit_rows
    row = ("TEST", "PRICE_ANOMALY", "WARNING", 3.5, 3.0, 180.0, 175.0, "TEST VWAP anomaly", ts(0), ts(60), ts(70))
    a = audit_rows(spark.createDataFrame([row], ALERTS))
    path = tempfile.mkdtemp(prefix="tidemark-rt-") + "/alerts"
    write_metrics_table(a, path, mode="overwrite")
    back = read_table(spark, path).collect()
    assert len(back) == 1
    r = back[0]
    assert (r.symbol, r.alert_type, r.severity, r.z_score, r.threshold, r.current_value, r.baseline_value) == \
        ("TEST", "PRICE_ANOMALY", "WARNING", 3.5, 3.0, 180.0, 175.0)
    assert r.acknowledged is False and r.detected_at == ts(70) and r.id is not None
