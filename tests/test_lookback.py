"""Alerts of a look-back from the trades it needs: equal to those of the whole table."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import SF_MID, T0, trades_df
from tidemark.operators.anomaly import detect_anomalies, metrics_with_history
from tidemark.operators.windows import window_metrics
from tidemark.sources.fixtures import Fixture

WINDOW = ("1 minute", "30 seconds")


def alerts(metrics, since, **options):
    a = detect_anomalies(metrics, detected_at="window_end", **options).where(F.col("window_end") >= since)
    return sorted(map(tuple, a.collect()))


def rows(symbol, times, spike=()):
    return [(symbol, 500.0 if t in spike else 100.0 + i % 3, 10, t) for i, t in enumerate(times)]


@pytest.mark.parametrize("reach", [None, "2 minutes", "0 seconds"])
def test_gaps_rare_and_new_symbols(spark, reach):
    late = 86400
    data = (rows("OFTEN", range(0, late + 600, 45), {late + 90})
            + rows("RARE", [*range(0, 6000, 300), late + 100], {late + 100})      # its history lies a day back
            + rows("SILENT", range(0, 9000, 100))                                 # no window in the look-back
            + rows("NEW", range(late, late + 600, 30), {late + 300}))
    trades = trades_df(spark, data).repartition(3)
    since = F.lit(T0 + dt.timedelta(seconds=late))
    want = alerts(window_metrics(trades, *WINDOW), since)
    part = metrics_with_history(trades, since, *WINDOW, reach=reach)
    assert {r[0] for r in want} == {"OFTEN", "RARE", "NEW"}
    assert alerts(part, since, chunk=None) == want == alerts(part, since)
    assert part.where("symbol = 'SILENT'").count() == 0
    assert part.where("symbol = 'RARE'").count() <= 22


def test_empty_trades_and_null_symbol_free_history(spark):
    trades = trades_df(spark, rows("A", [0]))
    since = F.lit(T0)
    assert alerts(metrics_with_history(trades.limit(0), since, *WINDOW), since) == []
    assert alerts(metrics_with_history(trades, since, *WINDOW), since) == []


@pytest.mark.parametrize("hours", [1, 24, 168, 2000])
def test_alert_table_of_a_look_back(spark, hours):
    fx = Fixture(spark, SF_MID)
    since = fx.anomaly_as_of() - F.expr(f"INTERVAL {hours} HOURS")
    key = ["symbol", "alert_type", "severity", "window_start", "message"]
    want = sorted(map(tuple, fx.alerts_table().where(F.col("detected_at") >= since).select(*key).collect()))
    assert sorted(map(tuple, fx.alerts_table(since).select(*key).collect())) == want


def test_old_trades_are_not_read_where_histories_are_full(spark, tmp_path):
    """The scan of older trades has its bound pushed down, and returns no row where nothing is short."""
    path = str(tmp_path / "trades")
    trades_df(spark, rows("A", range(0, 20000, 30))).repartitionByRange(4, "event_time").write.parquet(path)
    df = metrics_with_history(spark.read.parquet(path), F.lit(T0 + dt.timedelta(seconds=18000)), *WINDOW)
    assert df.agg(F.min("window_start")).first()[0] >= T0 + dt.timedelta(seconds=18000 - 60 - 4 * 20 * 30)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "event_time" in plan and "< Subquery" in plan.replace("scalar-subquery", "Subquery")
