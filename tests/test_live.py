"""Live state, dead letters, the alert table's second access path, progress table, replayed batches."""
import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import ts
from tidemark.operators.sinks import append_alerts, read_alert_table, read_table, write_metrics_table
from tidemark.operators.views import unacknowledged_alerts
from tidemark.schemas import RAW_TRADE
from tidemark.session import scratch_path
from tidemark.sources.alerts import CORRUPT, decode_alerts, read_raw_alerts
from tidemark.sources.trades import clean_trades, read_trades
from tidemark.streaming.app import forget_commit, start_market_stream
from tidemark.streaming.consumer import read_audit, read_dead_letters, start_alert_consumer
from tidemark.streaming.live import live_history, live_latest, live_top_movers, start_live_views
from tidemark.streaming.progress import ProgressCollector


def land(spark, root, rows):
    data = [(s, float(p), v, t, "X0", f"id{i}") for i, (s, p, v, t) in enumerate(rows)]
    spark.createDataFrame(data, RAW_TRADE).coalesce(1).write.mode("append").parquet(f"{root}/in")


def live(spark, root, **options):
    trades = clean_trades(read_trades(spark, f"{root}/in", "parquet", maxFilesPerTrigger=1), "timestamp")
    start_live_views(trades, f"{root}/state", "1 minute", "1 minute", trigger={"availableNow": True},
                     query_name=f"live-{uuid.uuid4().hex}", **options).awaitTermination()


def test_live_views_expire_and_survive_a_restart(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    land(spark, root, [("A", 10 + i, 1, ts(60 * i)) for i in range(6)] + [("B", 5, 2, ts(0))])
    live(spark, root, latest_ttl="10 minutes", history_ttl="30 minutes", size=4)
    land(spark, root, [("A", 20, 1, ts(360)), ("A", 40, 1, ts(370))])
    land(spark, root, [("~", 1, 1, ts(720))])  # the watermark: 11 min 30 s after the start
    live(spark, root, latest_ttl="10 minutes", history_ttl="30 minutes", size=4)
    state = f"{root}/state"
    latest = {r["symbol"]: r for r in live_latest(spark, state).collect()}
    assert set(latest) == {"A"} and latest["A"]["trade_count"] == 2 and latest["A"]["window_end"] == ts(420)
    assert live_top_movers(spark, state).collect()[0]["price_change_pct"] == 100.0
    history = sorted((r["symbol"], r["window_end"]) for r in live_history(spark, state).collect())
    assert history == [("A", ts(60 * k)) for k in (4, 5, 6, 7)] + [("B", ts(60))]  # four of seven, and B not yet
    land(spark, root, [("A", 3, 1, ts(7200)), ("~", 1, 1, ts(7300)), ("~", 1, 1, ts(7400))])  # after a gap
    land(spark, root, [("~", 1, 1, ts(7500))])
    live(spark, root, latest_ttl="10 minutes", history_ttl="30 minutes", size=4)
    again = sorted((r["symbol"], r["window_end"]) for r in live_history(spark, state).where("symbol <> '~'").collect())
    assert again == [("A", ts(7260))]
    with pytest.raises(ValueError):
        start_live_views(spark.range(1))


def test_a_replayed_batch_changes_nothing(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    for k in range(3):
        land(spark, root, [(s, 10 + k, 1, ts(600 * k + 20 * j)) for j in range(5) for s in ("A", "B")])

    def run():
        trades = clean_trades(read_trades(spark, f"{root}/in", "parquet", maxFilesPerTrigger=1), "timestamp")
        start_market_stream(trades, f"{root}/out", checkpoint=f"{root}/state", trigger={"availableNow": True},
                            detected_at="window_end", query_name=f"replay-{uuid.uuid4().hex}").awaitTermination()
        return sorted(map(str, spark.read.parquet(f"{root}/out/metrics").drop("created_at").collect()))

    first = run()
    assert first and forget_commit(spark, f"{root}/state") >= 2
    assert run() == first


def alert(symbol, minute):
    at = f"2024-01-01T10:{minute:02d}:00Z"
    return json.dumps({"symbol": symbol, "alert_type": "VOLUME_SPIKE", "severity": "INFO", "window_start": at, "window_end": at,
                       "detected_at": at})


def test_dead_letters_come_from_the_same_batches(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    lines = [[alert("A", 0), "not json", "[1]"], [alert("A", 0), alert("B", 1)], ['{"alert_type": "X"}', "", alert("C", 2)]]
    for part in lines:
        spark.createDataFrame([(x,) for x in part], "value string").coalesce(1).write.mode("append").text(f"{root}/in")

    def run():
        start_alert_consumer(decode_alerts(read_raw_alerts(spark, f"{root}/in", maxFilesPerTrigger=1)), f"{root}/out",
                             f"{root}/state", trigger={"availableNow": True}, query_name=f"d-{uuid.uuid4().hex}").awaitTermination()
        return (sorted(r[CORRUPT] for r in read_dead_letters(spark, f"{root}/out").collect()),
                sorted(r["symbol"] for r in read_audit(spark, f"{root}/out").collect()))

    want = sorted(["not json", "[1]", '{"alert_type": "X"}', ""]), ["A", "B", "C"]
    assert run() == want
    forget_commit(spark, f"{root}/state")
    assert run() == want  # idempotent on replay


def test_alerts_are_found_by_detection_date(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    day = dt.datetime(2024, 1, 1)
    rows = [(f"S{k}", day + dt.timedelta(days=k), day + dt.timedelta(days=k + 1, hours=1), k % 2 == 0) for k in range(6)]
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp, detected_at timestamp, acknowledged boolean") \
        .withColumn("alert_type", F.lit("X"))
    append_alerts(df, f"{root}/alerts", 0)
    append_alerts(df, f"{root}/alerts", 0)  # a replay
    got = read_alert_table(spark, f"{root}/alerts", since=day + dt.timedelta(days=5), until=day + dt.timedelta(days=6))
    assert [r["symbol"] for r in got.collect()] == ["S4"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "detected_dt" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert sorted(r["symbol"] for r in unacknowledged_alerts(df).collect()) == ["S1", "S3", "S5"]  # true ones are left out


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_stored_range_in_any_zone(spark, zone):
    root = scratch_path(spark, uuid.uuid4().hex)
    rows = spark.range(0, 240).select(F.lit("A").alias("symbol"), F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("window_start"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        write_metrics_table(rows, f"{root}/m")
        lo, hi = (F.timestamp_seconds(F.lit(1704067200 + h * 3600)) for h in (47, 50))
        got = read_table(spark, f"{root}/m", start=lo, end=hi)
        assert [r["s"] for r in got.select(F.unix_seconds("window_start").alias("s")).sort("s").collect()] == [
            1704067200 + h * 3600 for h in (47, 48, 49, 50)]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.split("PartitionFilters:")[1].split("]")[0].count("dt#") >= 2
        assert spark.read.parquet(f"{root}/m").select("dt").distinct().count() == 10
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_progress_collector_counts_what_it_loses():
    class Event:
        def __init__(self, k):
            self.progress = type("P", (), {"json": json.dumps({"batchId": k})})

    c = ProgressCollector(most=3)
    for k in range(5):
        c.onQueryProgress(Event(k))
    assert c.lost == 2 and [json.loads(x)["batchId"] for x in c.drain()] == [2, 3, 4]
