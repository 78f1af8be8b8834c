"""Detector (O-20…O-27): hand goldens, severity ladders, chunked == unchunked."""
import math

import pytest
from pyspark.sql import functions as F

from helpers import SF_MID
from helpers import metrics_df
from tidemark.functions.numeric import severity_by_levels
from tidemark.operators.anomaly import detect_anomalies, rolling_baseline
from tidemark.sources.fixtures import Fixture

HIST = [100, 101, 99, 100.5, 100.2, 99.8, 100.1]


def series(spark, vwaps, volumes=None, vols=None, symbol="AAPL", gap=30):
    n = len(vwaps)
    volumes = volumes or [1000] * n
    vols = vols or [0.5] * n
    rows = [(symbol, gap * (i + 1), float(vwaps[i]), int(volumes[i]), float(vols[i])) for i in range(n)]
    return metrics_df(spark, rows)


def alerts_of(spark, vwaps, **kw):
    return detect_anomalies(series(spark, vwaps, **kw), detected_at="window_end").collect()


def test_price_within_threshold_no_alert(spark):
    assert [a for a in alerts_of(spark, HIST + [100.3]) if a.alert_type == "PRICE_ANOMALY"
            and a.window_end.second == 0 and a.current_value == 100.3] == []


def test_price_anomaly_critical(spark):
    mean = sum(HIST) / len(HIST)
    std = math.sqrt(sum((v - mean) ** 2 for v in HIST) / len(HIST))
    cur = round(mean + 4.5 * std, 6)
    last = [a for a in alerts_of(spark, HIST + [cur]) if a.current_value == cur]
    assert len(last) == 1
    a = last[0]
    assert a.alert_type == "PRICE_ANOMALY" and a.severity == "CRITICAL"
    assert a.z_score == pytest.approx(4.5, abs=2e-4)
    assert a.threshold == 3.0 and a.baseline_value == pytest.approx(round(mean, 6), abs=1e-9)
    assert a.message.startswith("AAPL VWAP anomaly: Z-score=4.5")


def test_negative_z_score(spark):
    mean = sum(HIST) / len(HIST)
    std = math.sqrt(sum((v - mean) ** 2 for v in HIST) / len(HIST))
    cur = round(mean - 3.5 * std, 6)
    a = [x for x in alerts_of(spark, HIST + [cur]) if x.current_value == cur][0]
    assert a.z_score == pytest.approx(-3.5, abs=2e-4) and a.severity == "WARNING"


def test_severity_ladder(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (4.5,)], "z double")
    got = [r.s for r in df.select(severity_by_levels(F.col("z"), 4.0, 3.0).alias("s")).collect()]
    assert got == ["INFO", "WARNING", "CRITICAL"]


def test_volume_spike(spark):
    flat = [100.0] * 6
    a = alerts_of(spark, flat + [100.0], volumes=[10000] * 6 + [55000])
    vol = [x for x in a if x.alert_type == "VOLUME_SPIKE"]
    assert len(vol) == 1
    assert vol[0].z_score == 5.5 and vol[0].severity == "INFO" and vol[0].baseline_value == 10000.0
    assert vol[0].message == "AAPL volume spike: 5.5x above average (current=55000, avg=10000)"
    assert [x for x in alerts_of(spark, flat + [100.0], volumes=[10000] * 6 + [12000])
            if x.alert_type == "VOLUME_SPIKE"] == []


def test_volatility_spike_ladder(spark):
    a = alerts_of(spark, [100.0] * 5, vols=[0.1, 0.1, 0.1, 0.1, 0.7])
    v = [x for x in a if x.alert_type == "VOLATILITY_SPIKE"]
    assert len(v) == 1 and v[0].severity == "CRITICAL" and v[0].z_score == 7.0
    assert v[0].message == "AAPL volatility spike: 7.0x above rolling average"


def test_uniform_and_empty_history(spark):
    # constant vwap -> std 0 -> no price alert; the first row has an empty history -> nothing
    a = alerts_of(spark, [5.0] * 5)
    assert [x for x in a if x.alert_type == "PRICE_ANOMALY"] == []
    b = rolling_baseline(series(spark, [5.0] * 5), chunk=None).orderBy("window_end").collect()
    assert b[0].hist_n == 0 and b[0].price_mean is None
    assert b[4].price_mean == 5.0 and b[4].price_std == 0.0 and b[4].hist_n == 4


def test_history_is_previous_20_rows_excluding_current(spark):
    vw = [float(i) for i in range(1, 31)]
    b = rolling_baseline(series(spark, vw), chunk=None).orderBy("window_end").collect()
    r = b[25]  # 26th row: previous 20 are 6..25
    assert r.hist_n == 20 and r.price_mean == pytest.approx(sum(range(6, 26)) / 20)


def test_gaps_do_not_count(spark):
    # row-based history: a 10-hour gap between rows still leaves them adjacent
    rows = [("A", 30, 1.0, 1, 0.1), ("A", 36030, 3.0, 1, 0.1), ("A", 36060, 5.0, 1, 0.1)]
    b = rolling_baseline(metrics_df(spark, rows), chunk="1 hour").orderBy("window_end").collect()
    assert [r.hist_n for r in b] == [0, 1, 2] and b[2].price_mean == 2.0


def _cmp(a, b):
    cols = ["symbol", "window_end", "hist_n", "price_n", "price_mean", "price_std",
            "volume_mean", "volatility_mean"]
    ra = a.select(*cols).orderBy(*cols).collect()
    rb = b.select(*cols).orderBy(*cols).collect()
    assert ra == rb


@pytest.mark.parametrize("chunk", ["1 hour", "6 hours", "1 day", "7 days"])
def test_chunked_equals_unchunked_on_fixture(spark, chunk):
    m = Fixture(spark, SF_MID).metrics().select("symbol", "window_start", "window_end", "vwap",
                                                "volume", "volatility")
    _cmp(rolling_baseline(m, chunk=None), rolling_baseline(m, chunk=chunk))


def test_chunked_hot_symbol_and_sparse_chunks(spark):
    # one symbol holds most rows (dense), another has isolated rows far apart
    rows = [("HOT", 30 * (i + 1), 100 + (i % 17) * 0.37, 10 + i % 5, 0.01 * (i % 9)) for i in range(900)]
    rows += [("COLD", 3600 * 5 * k + 30, 50 + k, 3, 0.2) for k in range(30)]
    m = metrics_df(spark, rows)
    for chunk in ["5 minutes", "1 hour"]:
        _cmp(rolling_baseline(m, chunk=None), rolling_baseline(m, chunk=chunk))


def test_short_history_parameter(spark):
    m = series(spark, [float(i) for i in range(1, 12)])
    _cmp(rolling_baseline(m, history=3, chunk=None), rolling_baseline(m, history=3, chunk="1 minute"))


def test_fixture_alert_counts(spark):
    a = Fixture(spark, SF_MID).alerts().groupBy("alert_type").count().collect()
    assert {r.alert_type: r["count"] for r in a} == {
        "PRICE_ANOMALY": 214, "VOLUME_SPIKE": 2, "VOLATILITY_SPIKE": 375}


def test_reset_after_gap_golden(spark):
    # windows 30 s apart, then a 3 h gap, then two more: history restarts after the gap
    rows = [("A", 30 * (i + 1), 1.0 + i, 1, 0.1) for i in range(4)]
    rows += [("A", 30 * 4 + 3 * 3600 + 30 * j, 10.0 + j, 1, 0.1) for j in range(1, 3)]
    m = metrics_df(spark, rows)
    for chunk in (None, "1 hour", "1 day"):
        b = rolling_baseline(m, chunk=chunk, reset_after="2 hours").orderBy("window_end").collect()
        assert [r.hist_n for r in b] == [0, 1, 2, 3, 0, 1], chunk
        assert b[5].price_mean == 11.0


@pytest.mark.parametrize("chunk", ["1 hour", "1 day"])
def test_reset_after_chunked_equals_unchunked(spark, chunk):
    m = Fixture(spark, SF_MID).metrics().select("symbol", "window_start", "window_end", "vwap",
                                                "volume", "volatility")
    _cmp(rolling_baseline(m, chunk=None, reset_after="2 hours"),
         rolling_baseline(m, chunk=chunk, reset_after="2 hours"))


def test_reset_after_sparse_and_hot(spark):
    # a dense hot symbol with a 2-hour hole after every 50 windows, and a sparse one
    rows = [("HOT", 30 * (i + 1) + 7200 * (i // 50), 100 + (i % 13) * 0.5, 5, 0.01 * (i % 7))
            for i in range(600)]
    rows += [("COLD", 1800 * k + 30, 50 + k, 3, 0.2) for k in range(40)]
    m = metrics_df(spark, rows)
    for chunk in ("10 minutes", "1 hour", "6 hours"):
        for reset in ("45 minutes", "2 hours"):
            _cmp(rolling_baseline(m, chunk=None, reset_after=reset),
                 rolling_baseline(m, chunk=chunk, reset_after=reset))


def test_duplicate_window_rows_are_ordered_deterministically(spark):
    # at-least-once replays can leave two rows for one (symbol, window_end)
    rows = [("A", 30 * (i + 1), 10.0 + (i % 4), 1 + i % 3, 0.1) for i in range(60)]
    rows += [("A", 30 * (i + 1), 20.0 + i, 9, 0.3) for i in range(0, 60, 7)]
    m = metrics_df(spark, rows)
    for chunk in ("5 minutes", "1 hour"):
        _cmp(rolling_baseline(m, chunk=None), rolling_baseline(m, chunk=chunk))
