"""Structured Streaming: batch ≡ stream, idempotent replay, late data, stream de-dup, progress."""
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from helpers import ts
from tidemark.operators.anomaly import detect_anomalies
from tidemark.operators.dedup import dedup_alerts
from tidemark.operators.windows import window_metrics
from tidemark.schemas import ALERTS, RAW_TRADE
from tidemark.sources.fixtures import SENTINEL_SYMBOL, Fixture, land_raw_trades
from tidemark.sources.trades import clean_trades, read_trades
from tidemark.streaming.app import StreamPaths, fan_out, read_latest, start_market_stream
from tidemark.streaming.detector import dedup_stream
from tidemark.streaming.progress import progress_rows

METRIC_COLS = ["symbol", "window_start", "window_end", "vwap", "volatility", "rsi", "volume",
               "trade_count", "high", "low"]
ALERT_COLS = ["symbol", "alert_type", "severity", "z_score", "threshold", "current_value",
              "baseline_value", "message", "window_start", "window_end"]


def scratch():
    return tempfile.mkdtemp(prefix="tidemark-test-")


@pytest.fixture(scope="module")
def streamed(spark):
    root = scratch()
    fx = Fixture(spark, SF_SMALL)
    land_raw_trades(fx, f"{root}/in", n_files=4)
    trades = clean_trades(read_trades(spark, f"{root}/in", "parquet", maxFilesPerTrigger=1),
                          event_time="timestamp")
    q = start_market_stream(trades, f"{root}/out", checkpoint=f"{root}/ckpt", window="1 hour",
                            slide="30 minutes", trigger={"availableNow": True},
                            detected_at="window_end")
    q.awaitTermination()
    return fx, root, q


def _same(a, b, cols):
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_stream_metrics_equal_batch(spark, streamed):
    fx, root, _ = streamed
    s = spark.read.parquet(f"{root}/out/metrics").filter(F.col("symbol") != SENTINEL_SYMBOL)
    b = fx.metrics("1 hour", "30 minutes")
    b = b.withColumn("window_start", F.col("window_start").cast("timestamp")) \
         .withColumn("window_end", F.col("window_end").cast("timestamp"))
    assert s.count() == b.count() > 0
    _same(s, b, METRIC_COLS)


def test_stream_alerts_equal_batch(spark, streamed):
    fx, root, _ = streamed
    s = spark.read.parquet(f"{root}/out/alerts").filter(F.col("symbol") != SENTINEL_SYMBOL)
    b = dedup_alerts(detect_anomalies(fx.metrics("1 hour", "30 minutes"), detected_at="window_end"))
    b = b.withColumn("window_start", F.col("window_start").cast("timestamp")) \
         .withColumn("window_end", F.col("window_end").cast("timestamp"))
    assert s.count() == b.count() > 0
    _same(s, b, ALERT_COLS)
    assert s.filter(~F.col("acknowledged")).count() == s.count()


def test_latest_snapshot_and_progress(spark, streamed):
    fx, root, q = streamed
    latest = read_latest(spark, f"{root}/out").filter(F.col("symbol") != SENTINEL_SYMBOL)
    b = fx.metrics("1 hour", "30 minutes")
    want = {r.symbol: r.m for r in b.groupBy("symbol").agg(F.max("window_end").alias("m")).collect()}
    got = {r.symbol: r.window_end for r in latest.collect()}
    assert got == want
    rows = progress_rows(spark, q.recentProgress)
    names = {r.metric_name for r in rows.collect()}
    assert {"input_rows", "batch_duration_ms", "processed_rows_per_second"} <= names
    assert rows.filter(F.col("metric_name") == "input_rows").agg(F.sum("metric_value")).first()[0] > 0


def test_replayed_batch_is_idempotent(spark, streamed):
    fx, root, _ = streamed
    out = f"{scratch()}/out"
    m = fx.metrics("1 hour", "30 minutes").withColumn("window_start", F.col("window_start").cast("timestamp")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp"))
    from tidemark.operators.anomaly import rolling_baseline
    batch = rolling_baseline(m, chunk=None)
    sink = fan_out(StreamPaths(out), detected_at="window_end")
    sink(batch, 7)
    n1 = (spark.read.parquet(f"{out}/metrics").count(), spark.read.parquet(f"{out}/alerts").count())
    sink(batch, 7)  # the same micro-batch again, as after a restart
    n2 = (spark.read.parquet(f"{out}/metrics").count(), spark.read.parquet(f"{out}/alerts").count())
    assert n1 == n2 and n1[0] == m.count()
    sink(batch, 8)  # a later batch repeating the same alerts: de-dup keys already persisted
    assert spark.read.parquet(f"{out}/alerts").count() == n1[1]


def _land(spark, path, rows):
    data = [(s, float(p), v, t, "X0", f"id{i}") for i, (s, p, v, t) in enumerate(rows)]
    spark.createDataFrame(data, RAW_TRADE).coalesce(1).write.mode("append").parquet(path)


def test_late_row_behind_watermark_is_dropped(spark):
    root = scratch()
    inp = f"{root}/in"
    _land(spark, inp, [("A", 10, 1, ts(0)), ("A", 12, 1, ts(20))])
    _land(spark, inp, [("A", 11, 1, ts(200))])
    _land(spark, inp, [("A", 11, 1, ts(400))])
    _land(spark, inp, [("A", 99, 1, ts(10))])       # late: window [10:00, 10:01) closed long ago
    _land(spark, inp, [("A", 11, 1, ts(100000))])   # closes everything
    trades = clean_trades(read_trades(spark, inp, "parquet", maxFilesPerTrigger=1), "timestamp")
    m = window_metrics(trades, "1 minute", "30 seconds", "30 seconds")
    q = (m.writeStream.format("memory").queryName("late_test").outputMode("append")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    first = spark.sql("select * from late_test where window_start = timestamp'2024-01-01 10:00:00'").collect()
    assert len(first) == 1 and first[0].trade_count == 2 and first[0].high == 12.0
    dropped = progress_rows(spark, q.recentProgress).filter(
        F.col("metric_name") == "rows_dropped_by_watermark").agg(F.sum("metric_value")).first()[0]
    assert dropped >= 1


def test_dedup_stream_first_wins(spark):
    root = scratch()
    inp = f"{root}/in"
    rows = [("A", "PRICE_ANOMALY", "WARNING", 3.5, 3.0, 1.0, 1.0, "m", ts(0), ts(60), ts(60)),
            ("A", "PRICE_ANOMALY", "CRITICAL", 4.5, 3.0, 1.0, 1.0, "m", ts(30), ts(90), ts(90)),
            ("A", "PRICE_ANOMALY", "WARNING", 3.1, 3.0, 1.0, 1.0, "m", ts(300), ts(360), ts(360))]
    spark.createDataFrame(rows[:1], ALERTS).write.mode("append").parquet(inp)
    spark.createDataFrame(rows[1:], ALERTS).write.mode("append").parquet(inp)
    s = (spark.readStream.schema(ALERTS).option("maxFilesPerTrigger", 1).parquet(inp)
         .withWatermark("window_end", "10 minutes"))
    q = (dedup_stream(s).writeStream.format("memory").queryName("dedup_test").outputMode("append")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.window_start, r.severity) for r in spark.sql("select * from dedup_test").collect())
    assert got == [(ts(0), "WARNING"), (ts(300), "WARNING")]


def test_progress_listener_and_json_trade_source(spark):
    import json
    import time

    from tidemark.streaming.progress import ProgressCollector
    root = scratch()
    inp = f"{root}/in"
    import os
    os.makedirs(inp)
    with open(f"{inp}/part-0.json", "w") as f:
        for i, (s, p, v) in enumerate([("A", 10.0, 1), ("A", 12.0, 3), ("B", 5.0, 2), (None, 1.0, 1)]):
            f.write(json.dumps({"symbol": s, "price": p, "volume": v, "timestamp": f"2024-01-01T10:00:0{i}Z",
                                "exchange": "X0", "trade_id": str(i)}) + "\n")
    static = clean_trades(read_trades(spark, inp, "json", streaming=False), "timestamp")
    assert static.count() == 3
    listener = ProgressCollector()
    spark.streams.addListener(listener)
    try:
        trades = clean_trades(read_trades(spark, inp, "json"), "timestamp")
        q = (trades.writeStream.format("memory").queryName("json_trades")
             .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        deadline = time.time() + 10
        while not listener.events and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert spark.sql("select * from json_trades").count() == 3
    rows = listener.to_dataframe(spark).filter(F.col("metric_name") == "input_rows").collect()
    assert sum(r.metric_value for r in rows) == 3.0  # the NULL-symbol row is filtered inside the JSON reader
    assert rows[0].labels["query"] == "json_trades"


def test_restart_from_checkpoint_equals_batch(spark):
    """Run on the first half of the files, stop, land the rest, restart on the same
    checkpoint: window state, keyed history and sinks continue where they left off."""
    from tidemark.streaming.app import stop_when_idle
    root = scratch()
    fx = Fixture(spark, SF_SMALL)
    raw = fx.trades.select("symbol", "price", "volume", F.col("event_time").cast("timestamp").alias("timestamp"),
                           "exchange", "trade_id")
    lo, hi = raw.select(F.min("timestamp"), F.max("timestamp")).first()
    cut = lo + (hi - lo) / 2
    inp = f"{root}/in"

    def start():
        trades = clean_trades(read_trades(spark, inp, "parquet", maxFilesPerTrigger=1), "timestamp")
        return start_market_stream(trades, f"{root}/out", checkpoint=f"{root}/ckpt", window="1 hour",
                                   slide="30 minutes", trigger={"availableNow": True},
                                   detected_at="window_end", query_name="restart_test")

    raw.filter(F.col("timestamp") < F.lit(cut)).coalesce(1).write.mode("append").parquet(inp)
    q = start()
    q.awaitTermination()
    assert stop_when_idle(q) in (True, False) and not q.isActive
    first = spark.read.parquet(f"{root}/out/metrics").count()
    raw.filter(F.col("timestamp") >= F.lit(cut)).coalesce(1).write.mode("append").parquet(inp)
    land = spark.createDataFrame([(SENTINEL_SYMBOL, 1.0, 1, dt.datetime(2100, 1, 1), "X0", "s")], RAW_TRADE)
    land.coalesce(1).write.mode("append").parquet(inp)
    q2 = start()
    q2.awaitTermination()
    s = spark.read.parquet(f"{root}/out/metrics").filter(F.col("symbol") != SENTINEL_SYMBOL)
    assert 0 < first < s.count()
    b = fx.metrics("1 hour", "30 minutes")
    b = b.withColumn("window_start", F.col("window_start").cast("timestamp")) \
         .withColumn("window_end", F.col("window_end").cast("timestamp"))
    _same(s, b, METRIC_COLS)
    sa = spark.read.parquet(f"{root}/out/alerts").filter(F.col("symbol") != SENTINEL_SYMBOL)
    ba = dedup_alerts(detect_anomalies(fx.metrics("1 hour", "30 minutes"), detected_at="window_end"))
    ba = ba.withColumn("window_start", F.col("window_start").cast("timestamp")) \
           .withColumn("window_end", F.col("window_end").cast("timestamp"))
    _same(sa, ba, ALERT_COLS)


def test_stream_history_idle_expiry_resets_after_gap(spark):
    from tidemark.streaming.detector import stream_baseline
    root = scratch()
    inp = f"{root}/in"
    _land(spark, inp, [("A", 10 + i, 1, ts(60 * i + 5)) for i in range(4)])        # 4 one-minute windows
    _land(spark, inp, [("A", 20, 1, ts(3 * 3600 + 5)), ("A", 21, 1, ts(3 * 3600 + 65))])  # after a 3 h gap
    _land(spark, inp, [("A", 1, 1, ts(100000))])
    trades = clean_trades(read_trades(spark, inp, "parquet", maxFilesPerTrigger=1), "timestamp")
    m = window_metrics(trades, "1 minute", "1 minute", "30 seconds")
    for idle, name in ((3600 * 1000, "idle_on"), (None, "idle_off")):
        q = (stream_baseline(m, idle_ms=idle).writeStream.format("memory").queryName(name)
             .outputMode("append").option("checkpointLocation", f"{root}/ckpt_{name}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    on = [r.hist_n for r in spark.sql("select * from idle_on order by window_end").collect()]
    off = [r.hist_n for r in spark.sql("select * from idle_off order by window_end").collect()]
    assert off[:6] == [0, 1, 2, 3, 4, 5]
    assert on[:6] == [0, 1, 2, 3, 0, 1]


def test_append_progress_rows(spark, streamed):
    from tidemark.streaming.progress import append_progress
    _, _, q = streamed
    path = f"{scratch()}/pipeline_metrics"
    n = append_progress(spark, q.recentProgress, path)
    t = spark.read.parquet(path)
    assert n > 0 and t.count() == n
    assert {"metric_name", "metric_value", "labels", "recorded_at", "dt"} <= set(t.columns)


def test_stream_idle_expiry_equals_batch_reset(spark):
    from tidemark.operators.anomaly import rolling_baseline
    from tidemark.streaming.detector import IDLE_EXPIRY_MS, stream_baseline
    root = scratch()
    fx = Fixture(spark, SF_SMALL)
    land_raw_trades(fx, f"{root}/in", n_files=3)
    trades = clean_trades(read_trades(spark, f"{root}/in", "parquet", maxFilesPerTrigger=1), "timestamp")
    m = window_metrics(trades, "1 hour", "30 minutes", "30 seconds")
    q = (stream_baseline(m, idle_ms=IDLE_EXPIRY_MS).writeStream.format("memory").queryName("idle_eq")
         .outputMode("append").option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    s = spark.sql("select * from idle_eq").filter(F.col("symbol") != SENTINEL_SYMBOL)
    b = rolling_baseline(fx.metrics("1 hour", "30 minutes"), reset_after="2 hours")
    b = b.withColumn("window_end", F.col("window_end").cast("timestamp"))
    cols = ["symbol", "window_end", "hist_n", "price_n", "price_mean", "price_std", "volume_mean",
            "volatility_mean"]
    assert s.count() == b.count() > 0
    _same(s, b, cols)


def test_fan_out_sequential_matches_parallel(spark, streamed):
    from tidemark.operators.anomaly import rolling_baseline
    fx, _, _ = streamed
    m = fx.metrics("1 hour", "30 minutes").withColumn("window_start", F.col("window_start").cast("timestamp")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp"))
    batch = rolling_baseline(m, chunk=None)
    outs = []
    for parallel in (True, False):
        out = f"{scratch()}/out"
        fan_out(StreamPaths(out), detected_at="window_end", parallel=parallel)(batch, 3)
        outs.append(out)
    for table, cols in (("metrics", METRIC_COLS), ("alerts", ALERT_COLS)):
        a, b = (spark.read.parquet(f"{o}/{table}") for o in outs)
        assert a.count() == b.count() > 0
        _same(a, b, cols)
    assert read_latest(spark, outs[0]).count() == read_latest(spark, outs[1]).count() == 5
