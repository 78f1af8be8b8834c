"""The alert consumer: parse, de-dup, audit with stable ids, annotations; live views of the stream."""
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.views import latest_per_key
from tidemark.session import scratch_path
from tidemark.sources.alerts import CORRUPT, decode_alerts, read_alerts, read_raw_alerts
from tidemark.streaming.app import StreamPaths, _write_latest, forget_commit, read_history, read_latest, read_top_movers
from tidemark.streaming.consumer import read_audit, read_dead_letters, start_alert_consumer


def alert(symbol, minute, kind="VOLUME_SPIKE", severity="INFO"):
    at = f"2024-01-01T10:{minute:02d}:00Z"
    return json.dumps({"symbol": symbol, "alert_type": kind, "severity": severity, "z_score": 5.5, "threshold": 5.0,
                       "current_value": 1.0, "baseline_value": 0.2, "message": f"{symbol} spike", "window_start": at,
                       "window_end": at, "detected_at": at})


def test_consumer_dedups_and_gives_stable_ids(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    lines = [alert("A", 0), alert("A", 1), alert("A", 0), alert("B", 2), "not json", alert("A", 6), alert("A", 2, "PRICE_ANOMALY")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/in")
    found = []
    for run in ("x", "y"):  # two consumers of one topic see the same alerts
        good, _ = read_alerts(spark, f"{root}/in")
        start_alert_consumer(good, f"{root}/{run}", f"{root}/{run}-state", trigger={"availableNow": True},
                             query_name=f"c-{uuid.uuid4().hex}").awaitTermination()
        rows = read_audit(spark, f"{root}/{run}").collect()
        found.append(sorted((r["id"], r["symbol"], r["alert_type"], r["acknowledged"]) for r in rows))
        notes = spark.read.json(f"{root}/{run}/annotations")
        assert notes.count() == len(rows) == 4 and {r["text"] for r in notes.collect()} == {"A spike", "B spike"}
    assert found[0] == found[1] and len({r[0] for r in found[0]}) == 4 and all(r[0] >= 0 and r[3] is False for r in found[0])
    with pytest.raises(ValueError):
        start_alert_consumer(spark.range(1), root)


def test_latest_state_of_many_symbols(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    paths = StreamPaths(root)

    def batch(ids, end):
        return ids.select(F.concat(F.lit("S"), F.col("id")).alias("symbol"), F.timestamp_seconds(F.lit(end - 60)).alias("window_start"),
                          F.timestamp_seconds(F.lit(end)).alias("window_end"), F.lit(1.0 * end).alias("vwap"), F.lit(0.1).alias("volatility"),
                          F.lit(50.0).alias("rsi"), F.lit(5).cast("bigint").alias("volume"), F.lit(1).cast("bigint").alias("trade_count"),
                          F.lit(3.0).alias("high"), F.lit(2.0).alias("low"))
    _write_latest(batch(spark.range(100_000), 60), paths, 0)
    _write_latest(batch(spark.range(7), 120), paths, 1)
    _write_latest(batch(spark.range(7), 120), paths, 1)  # a replay
    got = read_latest(spark, root)
    assert got.count() == 100_000 and got.where("vwap = 120").count() == 7
    assert read_top_movers(spark, root).where("price_change_pct = 50").count() == 100_000
    batch(spark.range(3), 60).unionByName(batch(spark.range(3), 120)).write.parquet(paths.metrics)
    assert read_history(spark, root, 1).where("vwap = 120").count() == 3


def test_latest_views_use_hash_aggregates(spark):
    df = spark.createDataFrame([("A", 1, 2.0)], "symbol string, window_end int, vwap double")
    plan = latest_per_key(df, "symbol", "window_end")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_late_first_alerts_are_kept(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    for lines in ([alert("A", 50)], [alert("A", 0), alert("A", 50), alert("B", 1)], [alert("A", 2), alert("B", 55), alert("C", 0)]):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
    good, _ = read_alerts(spark, f"{root}/in", maxFilesPerTrigger=1)
    q = start_alert_consumer(good, f"{root}/out", f"{root}/state", trigger={"availableNow": True}, query_name=f"c-{uuid.uuid4().hex}")
    q.awaitTermination()
    got = sorted((r["symbol"], r["window_start"].minute) for r in read_audit(spark, f"{root}/out").collect())
    assert got == [("A", 0), ("A", 50), ("B", 1), ("B", 55), ("C", 0)]
    assert spark.read.json(f"{root}/out/annotations").count() == 5


def _consume(spark, root, lines, **more):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
    q = start_alert_consumer(decode_alerts(read_raw_alerts(spark, f"{root}/in")), f"{root}/out", f"{root}/state",
                             trigger={"availableNow": True}, query_name=f"c-{uuid.uuid4().hex}", **more)
    q.awaitTermination()
    return sorted((r["symbol"], r["severity"]) for r in read_audit(spark, f"{root}/out").collect())


def test_repeats_are_known_after_a_restart_and_a_replay(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    assert _consume(spark, root, [alert("A", 0), alert("A", 0), "broken"]) == [("A", "INFO")]
    want = [("A", "INFO"), ("B", "INFO")]
    assert _consume(spark, root, [alert("A", 0, severity="CRITICAL"), alert("B", 1)]) == want
    forget_commit(spark, f"{root}/state")
    assert _consume(spark, root, [alert("B", 1, severity="WARNING"), "broken too"]) == want
    assert sorted(r[CORRUPT] for r in read_dead_letters(spark, f"{root}/out").collect()) == ["broken", "broken too"]


def test_forgotten_keys_count_as_new(spark):
    root = scratch_path(spark, uuid.uuid4().hex)
    assert _consume(spark, root, [alert("A", 0)], remember_ms=1) == [("A", "INFO")]
    _consume(spark, root, [alert("B", 0)], remember_ms=1)
    got = _consume(spark, root, [alert("A", 0, severity="WARNING")], remember_ms=1)
    assert got == [("A", "INFO"), ("A", "WARNING"), ("B", "INFO")]
