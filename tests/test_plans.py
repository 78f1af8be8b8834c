"""Physical-plan properties the scale design relies on."""
import tempfile

from pyspark.sql import functions as F

from helpers import SF_SMALL
from tidemark import catalog
from tidemark.operators import sinks
from tidemark.operators.anomaly import rolling_baseline
from tidemark.plans import serving
from tidemark.sources.fixtures import Fixture


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunked_baseline_never_windows_metric_rows_by_symbol_alone(spark):
    m = Fixture(spark, SF_SMALL).anomaly_table
    p = plan(rolling_baseline(m))
    # every Window over metric rows is partitioned by (symbol, _chunk); the only
    # symbol-only window runs over the one-row-per-chunk tails table (collect_list)
    for line in p.split("\n"):
        if "Window [" in line and "windowspecdefinition(symbol" in line and "_chunk" in line:
            spec = line.split("windowspecdefinition(")[1]
            if spec.split(",")[1].strip().startswith("_chunk") and "ASC" in spec.split(",")[1]:
                assert "collect_list" in line
    assert "WindowGroupLimit" in p and "Partial" in p


def test_window_metrics_prunes_and_pushes(spark):
    df = catalog.q_window_metrics(spark, SF_SMALL)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), GreaterThan(value,0.0)" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_serving_top_k_and_pushdown_on_tables(spark):
    path = tempfile.mkdtemp(prefix="tidemark-plan-") + "/metrics"
    sinks.write_metrics_table(Fixture(spark, SF_SMALL).metrics_table(), path, mode="overwrite")
    t = spark.read.parquet(path)
    h = serving.history(t, "purchase", start=F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"),
                        end=F.lit("2024-01-11 00:00:00").cast("timestamp_ntz"), limit=50)
    p = plan(h)
    assert "TakeOrderedAndProject" in p
    assert "EqualTo(symbol,PURCHASE)" in p
    assert 0 < h.count() <= 50


def test_serving_time_filters_prune_date_partitions(spark):
    import datetime as dt
    path = tempfile.mkdtemp(prefix="tidemark-plan-") + "/metrics"
    sinks.write_metrics_table(Fixture(spark, SF_SMALL).metrics_table(), path, mode="overwrite")
    t = spark.read.parquet(path)
    asof = F.lit(dt.datetime(2024, 1, 20, 12, 0)).cast("timestamp_ntz")
    for df in (serving.recent_metrics(t, as_of=asof, lookback="6 hours"),
               serving.history(t, "click", start=asof - F.expr("INTERVAL 2 DAYS"), end=asof)):
        p = plan(df)
        assert "PartitionFilters: [isnotnull(dt" in p and "(dt#" in p.split("PartitionFilters")[1][:200]
        assert df.count() > 0


def test_cluster_conf_sizes_by_cores():
    from tidemark.session import cluster_conf
    c = cluster_conf(100e12, executors=1000, cores_per_executor=8, executor_memory_gb=32)
    assert c["spark.sql.shuffle.partitions"] == str(3 * 8000)
    assert c["spark.sql.files.maxPartitionBytes"] == "256m"
    assert c["spark.sql.adaptive.enabled"] == "true" and c["spark.ui.enabled"] == "false"
    small = cluster_conf(1e9, executors=2, cores_per_executor=8, executor_memory_gb=4)
    assert small["spark.sql.files.maxPartitionBytes"] == "128m"


def test_panel_time_bounds_reach_the_scan(spark):
    """A look-back panel filters trades on event_time below the windows, and learns NOW() from one column."""
    from tidemark import catalog
    plan = catalog.q_dash_volume_series(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Expand"):] if "Expand" in plan else plan[plan.index("Aggregate"):]
    assert ">= (scalar-subquery" in below.replace(" - INTERVAL", ") - INTERVAL") or ">= cast(scalar" in below or "scalar-subquery" in below
    assert plan.count("Aggregate [symbol") <= 1
