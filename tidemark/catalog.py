"""Registered queries: name -> (DataFrame builder over a driver-table folder, DuckDB SQL).

Every query reads the driver tables and runs the library's own operators over
the whole ``events`` table. Look-backs of serving/dashboard queries are widened
where the reference default (an hour of a live feed) would select almost
nothing of a 30-day fixture; ``as_of`` is the newest window_end (scalar subquery).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import oracle as O
from .functions.numeric import round_half_up
from .functions.timecols import as_interval
from .operators import anomaly, dedup, sinks, views
from .plans import dashboards as D, serving as S
from .schemas import METRIC_COLUMNS
from .sources.fixtures import ANOMALY_WINDOW, METRIC_WINDOW, Fixture
from .sources.alerts import parse_alert_json
from .sources.quotes import normalize_quotes

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

SYMBOL = "PURCHASE"
ALERT_COLS = ["symbol", "alert_type", "severity", "z_score", "threshold", "current_value",
              "baseline_value", "window_start", "window_end", "detected_at"]


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- trades / windows
@register("trades_clean", f"WITH {O.TRADES} SELECT * FROM trades")
def q_trades_clean(spark, sf):
    """O-6/O-7: trade projection + validity filter."""
    return Fixture(spark, sf).trades


@register("window_metrics", O.with_metrics(
    "SELECT * EXCLUDE (created_at) FROM m1"))
def q_window_metrics(spark, sf):
    """O-8…O-13: 1-minute windows sliding by 30 s."""
    return Fixture(spark, sf).metrics()


@register("window_metrics_hourly", f"WITH {O.TRADES},\n{O.MH}\nSELECT * EXCLUDE (created_at) FROM mh")
def q_window_metrics_hourly(spark, sf):
    """O-9…O-13 at the detector's 1 h / 30 min windows."""
    return Fixture(spark, sf).anomaly_metrics()


# ---------------------------------------------------------------- anomaly detection
_BASE_OUT = """SELECT symbol, window_start, window_end, vwap, volume, volatility, hist_n, price_n,
       floor(price_mean * 1000000000.0 + 0.5) / 1000000000.0 AS price_mean,
       floor(price_std * 10000000.0 + 0.5) / 10000000.0 AS price_std,
       floor(volume_mean * 10000.0 + 0.5) / 10000.0 AS volume_mean,
       floor(volatility_mean * 100000000000.0 + 0.5) / 100000000000.0 AS volatility_mean
FROM base"""


@register("rolling_baseline", f"WITH {O.TRADES},\n{O.MH},\n{O.BASE}\n{_BASE_OUT}")
def q_rolling_baseline(spark, sf):
    """O-20/O-21: previous-20-window stats per symbol (chunked + halo, no per-symbol task)."""
    m = Fixture(spark, sf).anomaly_table.select("symbol", "window_start", "window_end",
                                                "vwap", "volume", "volatility")
    b = anomaly.rolling_baseline(m)
    return b.select("symbol", "window_start", "window_end", "vwap", "volume", "volatility",
                    "hist_n", "price_n",
                    round_half_up("price_mean", 9).alias("price_mean"),
                    round_half_up("price_std", 7).alias("price_std"),
                    round_half_up("volume_mean", 4).alias("volume_mean"),
                    round_half_up("volatility_mean", 11).alias("volatility_mean"))


@register("rolling_baseline_reset",
          f"WITH {O.TRADES},\n{O.MH},\n{O.SEGMENTS.format(reset_s=7200)},\n"
          f"{O._base('segd', 'symbol, seg')}\n{_BASE_OUT}")
def q_rolling_baseline_reset(spark, sf):
    """O-20/O-21/O-28: rolling stats whose history expires after a 2-hour gap between a
    symbol's windows (the live store's expiry, in event time)."""
    m = Fixture(spark, sf).anomaly_table.select("symbol", "window_start", "window_end",
                                                "vwap", "volume", "volatility")
    b = anomaly.rolling_baseline(m, reset_after="2 hours")
    return b.select("symbol", "window_start", "window_end", "vwap", "volume", "volatility",
                    "hist_n", "price_n",
                    round_half_up("price_mean", 9).alias("price_mean"),
                    round_half_up("price_std", 7).alias("price_std"),
                    round_half_up("volume_mean", 4).alias("volume_mean"),
                    round_half_up("volatility_mean", 11).alias("volatility_mean"))


def _alert_panel(spark, sf, lookback: str):
    """The alerts of a look-back, computed from the trades it needs, and NOW()."""
    fx = Fixture(spark, sf)
    now = fx.anomaly_as_of()
    return fx.alerts_table(since=now - as_interval(lookback)), now


def _alerts(spark, sf, alert_type=None):
    a = Fixture(spark, sf).alerts().select(*ALERT_COLS)
    return a if alert_type is None else a.filter(F.col("alert_type") == alert_type)


@register("detect_alerts", O.with_alerts("SELECT * FROM alerts"))
def q_detect_alerts(spark, sf):
    """O-22…O-26: all three signals in one pass (message column checked separately)."""
    return _alerts(spark, sf)


@register("price_anomalies", O.with_alerts("SELECT * FROM alerts WHERE alert_type = 'PRICE_ANOMALY'"))
def q_price_anomalies(spark, sf):
    """O-22/O-23: VWAP z-score signal and its severity ladder."""
    return _alerts(spark, sf, "PRICE_ANOMALY")


@register("volume_spikes", O.with_alerts("SELECT * FROM alerts WHERE alert_type = 'VOLUME_SPIKE'"))
def q_volume_spikes(spark, sf):
    """O-24: volume > 5x rolling mean."""
    return _alerts(spark, sf, "VOLUME_SPIKE")


@register("volatility_spikes", O.with_alerts("SELECT * FROM alerts WHERE alert_type = 'VOLATILITY_SPIKE'"))
def q_volatility_spikes(spark, sf):
    """O-25: volatility > 3x rolling mean."""
    return _alerts(spark, sf, "VOLATILITY_SPIKE")


@register("alert_messages", O.with_messages("SELECT symbol, alert_type, window_end, message FROM messages"))
def q_alert_messages(spark, sf):
    """O-27: alert message text."""
    return Fixture(spark, sf).alerts().select("symbol", "alert_type", "window_end", "message")


# ---------------------------------------------------------------- de-duplication
@register("alert_dedup_keys", O.with_alerts("SELECT * FROM keyed"))
def q_alert_dedup_keys(spark, sf):
    """O-29: md5 de-dup key over (symbol, type, 5-minute bucket)."""
    return dedup.with_dedup_key(_alerts(spark, sf))


@register("alerts_deduped", O.with_alerts("SELECT * EXCLUDE (dedup_key) FROM deduped", O.REPLAYED))
def q_alerts_deduped(spark, sf):
    """O-30: first alert per de-dup key wins, over alerts of which each is sent again 10 s later."""
    sent = _alerts(spark, sf)
    again = sent.withColumn("detected_at", F.col("detected_at") + F.expr("INTERVAL 10 SECONDS"))
    return dedup.dedup_alerts(sent.unionByName(again))


# ---------------------------------------------------------------- sinks / views
@register("enriched_json", O.with_metrics("SELECT symbol AS key, * EXCLUDE (created_at) FROM m1"))
def q_enriched_json(spark, sf):
    """O-31: keyed JSON messages of the METRICS stream, decoded again field by field."""
    metrics = Fixture(spark, sf).metrics()
    messages = sinks.to_keyed_json(metrics)
    fields = F.from_json("value", metrics.schema, {"mode": "FAILFAST"})
    return messages.select("key", fields.alias("m")).select("key", "m.*")


@register("alerts_json_roundtrip", O.with_alerts("SELECT * FROM alerts"))
def q_alerts_json_roundtrip(spark, sf):
    """O-31 + O-3: alerts encoded as keyed JSON messages, then decoded by the alert-stream
    parser (timestamps travel as ISO text); every message must decode to the same row."""
    alerts = _alerts(spark, sf)
    good, _ = parse_alert_json(sinks.to_keyed_json(alerts).select("value"))
    ntz = alerts.schema["window_start"].dataType
    return good.select(*[F.col(c).cast(ntz).alias(c) if c in ("window_start", "window_end", "detected_at")
                         else F.col(c) for c in ALERT_COLS])


@register("alert_annotations", O.with_messages("""
SELECT '' AS "dashboardUID", epoch_ms(window_end) AS time, alert_type || ',' || severity || ',' || symbol AS tags,
       message AS text FROM messages"""))
def q_alert_annotations(spark, sf):
    """O-37: dashboard annotation payloads of the alerts that de-duplication keeps."""
    return (sinks.alert_annotations(Fixture(spark, sf).alerts_table())
            .withColumn("tags", F.array_join("tags", ",")))


@register("latest_state", O.with_metrics(f"""
SELECT symbol, window_start, window_end, vwap, volatility, rsi, volume, trade_count, high, low,
       epoch_ms(created_at) AS updated_at
FROM m1 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1
   AND epoch_ms(created_at) >= epoch_ms({O.AS_OF_M1} - INTERVAL 1 HOUR)"""))
def q_latest_state(spark, sf):
    """O-33: latest row per symbol + updated_at ms; TTL widened to 1 h for the fixture."""
    fx = Fixture(spark, sf)
    return views.latest_state(fx.metrics_table(), as_of=fx.as_of(), ttl="1 hour")


@register("metric_history", O.with_metrics("""
SELECT * EXCLUDE (created_at), row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) AS rank
FROM m1 QUALIFY rank <= 120"""))
def q_metric_history(spark, sf):
    """O-34: last 120 windows per symbol."""
    return views.metric_history(Fixture(spark, sf).metrics())


_TOP = """SELECT symbol, floor(CASE WHEN low > 0 THEN (high - low) / low * 100.0 ELSE 0.0 END * 10000.0 + 0.5)
              / 10000.0 AS price_change_pct
FROM m1 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1
ORDER BY price_change_pct DESC, symbol DESC LIMIT 10"""


@register("top_movers", O.with_metrics(_TOP))
def q_top_movers(spark, sf):
    """O-35/O-45: range-% of each symbol's latest window, top 10."""
    return S.top_movers(Fixture(spark, sf).metrics(), n=10)


@register("latest_metrics", O.with_metrics("""
SELECT * FROM m1 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1"""))
def q_latest_metrics(spark, sf):
    """O-38: DISTINCT ON (symbol) newest window incl. created_at."""
    return views.latest_metrics(Fixture(spark, sf).metrics_table())


@register("alert_summary_view", O.with_alerts(f"""
SELECT symbol, severity, alert_type, count(*) AS alert_count, max(detected_at) AS last_detected,
       floor(avg(z_score) * 100000000.0 + 0.5) / 100000000.0 AS avg_z_score
FROM atab WHERE detected_at > {O.AS_OF_MH} - INTERVAL 24 HOUR
GROUP BY symbol, severity, alert_type"""))
def q_alert_summary_view(spark, sf):
    """O-39: 24 h alert summary (count, last detection, mean z)."""
    a, now = _alert_panel(spark, sf, "24 hours")
    return views.alert_summary_view(a, as_of=now, hours=24)


@register("alerts_unacknowledged", O.with_alerts("""
SELECT symbol, alert_type, severity, z_score, threshold, current_value, baseline_value,
       window_start, window_end, detected_at, acknowledged FROM atab WHERE NOT acknowledged"""))
def q_alerts_unacknowledged(spark, sf):
    """O-40: acknowledged = false, newest first."""
    t = Fixture(spark, sf).alerts_table()
    return views.unacknowledged_alerts(t).select(*ALERT_COLS, "acknowledged")


# ---------------------------------------------------------------- the stream
#: Queries that run a stream to its end while they are built, and read its tables or state.
STREAM_QUERIES = ("stream_window_metrics", "stream_latest", "stream_alerts", "alert_audit", "alert_dead_letters",
                  "stream_restarted", "live_latest", "live_history", "live_top_movers", "pipeline_metrics", "stored_range",
                  "stored_alerts", "stream_late_rows", "stored_compacted")
#: Slices of time that the trades land in, files of each.
SLICES, FILES = 3, 4


def _stream_root(spark):
    """A new folder for a stream's input, state and output."""
    import tempfile
    import uuid

    from .session import scratch_path

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))  # a session on one machine
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return scratch_path(spark, "stream-query", uuid.uuid4().hex)


def _landed(spark, root):
    """The stream of the trades that have landed under ``root``, a slice of time per batch."""
    from .sources.trades import clean_trades, read_trades
    return clean_trades(read_trades(spark, f"{root}/in", "parquet", maxFilesPerTrigger=FILES), event_time="timestamp")


def _run(spark, root, window, slide):
    """Run the market stream over what has landed, from its checkpoint, until all is read."""
    import uuid

    from .streaming.app import start_market_stream
    q = start_market_stream(_landed(spark, root), f"{root}/out", checkpoint=f"{root}/state", window=window, slide=slide,
                            trigger={"availableNow": True}, detected_at="window_end", query_name=f"q-{uuid.uuid4().hex}")
    q.awaitTermination()
    return q


def _streamed(spark, sf, window, slide):
    """Run the market stream over the trades of ``events``, landed as files in time order, until
    all are read; returns its output folder. A sentinel trade closes the last windows."""
    from .sources.fixtures import land_raw_trades
    root = _stream_root(spark)
    land_raw_trades(Fixture(spark, sf), f"{root}/in", n_files=SLICES, files=FILES)
    _run(spark, root, window, slide)
    return f"{root}/out"


def _wall(df):
    """Timestamps as the driver tables hold them, UTC wall clock."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


@register("stream_window_metrics", O.with_metrics("SELECT * EXCLUDE (created_at) FROM m1"))
def q_stream_window_metrics(spark, sf):
    """O-1, O-14…O-19, O-32: the metrics table that the stream appends (1 min / 30 s windows,
    30 s watermark, checkpoint, idempotent batches)."""
    out = _streamed(spark, sf, *METRIC_WINDOW)
    return _wall(spark.read.parquet(f"{out}/metrics").select(*METRIC_COLUMNS))


@register("stream_latest", O.with_metrics("""
SELECT * EXCLUDE (created_at) FROM m1 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1"""))
def q_stream_latest(spark, sf):
    """O-33: the live latest state after the stream has read everything."""
    from .streaming.app import read_latest
    return _wall(read_latest(spark, _streamed(spark, sf, *METRIC_WINDOW)).select(*METRIC_COLUMNS))


@register("stream_alerts", O.with_alerts("SELECT * EXCLUDE (created_at) FROM atab"))
def q_stream_alerts(spark, sf):
    """O-28, O-36: alerts of the stateful detector as the stream's audit table holds them."""
    out = _streamed(spark, sf, *ANOMALY_WINDOW)
    return _wall(spark.read.parquet(f"{out}/alerts").select(*ALERT_COLS, "acknowledged"))


@register("stream_restarted", O.with_alerts("""
SELECT 'metric' AS kind, symbol, window_end, NULL AS alert_type, vwap AS value FROM mh
UNION ALL SELECT 'alert', symbol, window_end, alert_type, current_value FROM atab"""))
def q_stream_restarted(spark, sf):
    """O-17: the stream stops after two slices of its input, loses the commit of its last batch, as
    in a crash between sinks and commit, and starts again twice: it replays that batch, then
    reads what has landed meanwhile. Tables and alerts are those of a run without a stop."""
    from .sources.fixtures import dealt, raw_trades, sentinel, time_slices
    from .streaming.app import forget_commit
    fx, root = Fixture(spark, sf), _stream_root(spark)
    slices = time_slices(raw_trades(fx), SLICES)
    for rows in slices[:-1]:
        dealt(rows, FILES).write.mode("append").parquet(f"{root}/in")
    _run(spark, root, *ANOMALY_WINDOW)
    forget_commit(spark, f"{root}/state")
    _run(spark, root, *ANOMALY_WINDOW)
    dealt(slices[-1], FILES).write.mode("append").parquet(f"{root}/in")
    sentinel(fx).write.mode("append").parquet(f"{root}/in")
    _run(spark, root, *ANOMALY_WINDOW)
    metrics, alerts = (spark.read.parquet(f"{root}/out/{t}") for t in ("metrics", "alerts"))
    return _wall(metrics.select(F.lit("metric").alias("kind"), "symbol", "window_end", F.lit(None).cast("string").alias("alert_type"),
                                F.col("vwap").alias("value"))
                 .unionByName(alerts.select(F.lit("alert").alias("kind"), "symbol", "window_end", "alert_type",
                                            F.col("current_value").alias("value"))))


_LATE = f"""WITH {O.TRADES}, half AS (SELECT make_timestamp((epoch_us(min(event_time)) + epoch_us(max(event_time))) // 2) AS cut FROM trades),
came AS (SELECT t.*, event_time < cut AND CAST(trade_id AS BIGINT) % 20 = 0 AS delayed, event_time < cut AS early FROM trades t, half),
mark AS (SELECT epoch_ms(max(event_time)) - 30000 AS ms FROM came WHERE early AND NOT delayed),
seen AS (SELECT symbol, volume, ws AS window_start, delayed AND epoch_ms(ws) + 60000 <= ms AS missed
  FROM (SELECT c.*, time_bucket(INTERVAL 30 SECOND, event_time, TIMESTAMP '1970-01-01') - r.i * INTERVAL 30 SECOND AS ws
        FROM came c, range(2) r(i)), mark)
SELECT CASE WHEN missed THEN 'late' ELSE 'metric' END AS kind, symbol, window_start, count(*) AS trades,
       CAST(sum(volume) AS BIGINT) AS volume
FROM seen GROUP BY ALL
UNION ALL SELECT 'dropped', NULL, NULL, count(DISTINCT (symbol, window_start)), 0 FROM seen WHERE missed"""


@register("stream_late_rows", _LATE)
def q_stream_late_rows(spark, sf):
    """O-14: one trade in twenty of the earlier half of the time comes with the later half. What windows still
    take counts; what comes after a window has closed is in the late table, and the windows there
    are as many as the watermark is reported to have dropped."""
    import uuid

    from .sources.fixtures import dealt, raw_trades, sentinel
    from .sources.trades import clean_trades, read_trades
    from .streaming.app import read_late, start_market_stream
    fx, root = Fixture(spark, sf), _stream_root(spark)
    rows, at = raw_trades(fx), F.unix_micros("timestamp")
    cut = rows.select(F.expr("(unix_micros(min(timestamp)) + unix_micros(max(timestamp))) div 2")).scalar()
    delayed = (at < cut) & (F.col("trade_id").cast("bigint") % 20 == 0)
    dropped = 0
    for part in (rows.where((at < cut) & ~delayed), rows.where((at >= cut) | delayed), None):
        landing = sentinel(fx) if part is None else dealt(part, FILES)
        landing.write.mode("append").parquet(f"{root}/in")
        trades = clean_trades(read_trades(spark, f"{root}/in", "parquet"), event_time="timestamp")
        q = start_market_stream(trades, f"{root}/out", checkpoint=f"{root}/state", window=METRIC_WINDOW[0], slide=METRIC_WINDOW[1],
                                trigger={"availableNow": True}, detected_at="window_end", late_table=True,
                                query_name=f"q-{uuid.uuid4().hex}")
        q.awaitTermination()
        dropped += sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])
    late = read_late(spark, f"{root}/out").groupBy("symbol", "window_start").agg(
        F.count("*").alias("trades"), F.sum("volume").alias("volume"))
    metrics = spark.read.parquet(f"{root}/out/metrics").select(
        "symbol", "window_start", F.col("trade_count").alias("trades"), "volume")
    total = spark.range(1).select(F.lit("dropped").alias("kind"), F.lit(None).cast("string").alias("symbol"),
                                  F.lit(None).cast("timestamp").alias("window_start"), F.lit(dropped).cast("bigint").alias("trades"),
                                  F.lit(0).cast("bigint").alias("volume"))
    return _wall(metrics.select(F.lit("metric").alias("kind"), "*").unionByName(late.select(F.lit("late").alias("kind"), "*"))
                 .unionByName(total))


def _consumed(spark, sf):
    """The alert consumer over every alert that the stream sends, each sent twice, and a malformed
    message for each two, in batches that each reach over the whole time; returns its folder."""
    from .sources.alerts import decode_alerts, read_raw_alerts
    from .streaming.consumer import start_alert_consumer
    out = _streamed(spark, sf, *ANOMALY_WINDOW)
    raw = spark.read.text(f"{out}/alerts_raw").select("value")
    broken = raw.select(F.when(F.crc32("value") % 2 == 0, F.expr("left(value, length(value) div 2)"))
                        .otherwise(F.regexp_replace("value", '"symbol":"[^"]*",', "")).alias("value"))
    files = max(4, spark.sparkContext.defaultParallelism)
    raw.unionByName(raw).unionByName(broken).repartition(files).write.text(f"{out}/topic")
    q = start_alert_consumer(decode_alerts(read_raw_alerts(spark, f"{out}/topic", maxFilesPerTrigger=-(-files // 4))),
                             f"{out}/consumer", checkpoint=f"{out}/consumer-state",
                             trigger={"availableNow": True}, query_name="q-consumer-" + out.split("/")[-2])
    q.awaitTermination()
    return f"{out}/consumer"


@register("alert_audit", O.with_alerts("SELECT * EXCLUDE (created_at) FROM atab"))
def q_alert_audit(spark, sf):
    """O-3, O-29, O-30, O-36, O-37: the consumer's audit table holds each alert once."""
    from .streaming.consumer import read_audit
    return _wall(read_audit(spark, _consumed(spark, sf)).select(*ALERT_COLS, "acknowledged"))


@register("alert_dead_letters", O.with_alerts("SELECT count(*) AS messages FROM alerts"))
def q_alert_dead_letters(spark, sf):
    """O-3: every malformed message, cut off or without a symbol, comes out as a dead letter, and
    nothing else does."""
    from .sources.alerts import CORRUPT
    from .streaming.consumer import read_dead_letters
    letters = read_dead_letters(spark, _consumed(spark, sf))
    return letters.where(~F.col(CORRUPT).rlike('^[{].*"symbol":.*[}]$')).agg(F.count("*").alias("messages"))


# ---------------------------------------------------------------- live state
#: Fixed values of the live queries: the closing trade comes two minutes after the last one, and the
#: watermark stays 30 s behind it; symbols trade about every 20 minutes, so some have expired.
CLOSING, LIVE_TTL, LIVE_HISTORY_TTL = "2 minutes", "1200500 milliseconds", "6 hours"
_WATERMARK = "(SELECT max(event_time) + INTERVAL 90 SECOND FROM trades)"
_NEWEST = "max(window_end) OVER (PARTITION BY symbol)"


def _live(spark, sf):
    """Run the live views over the trades, stopped and started again before the last slice; returns
    the checkpoint that holds their state."""
    import uuid

    from .functions.timecols import as_interval
    from .sources.fixtures import dealt, raw_trades, sentinel, time_slices
    from .streaming.live import start_live_views
    fx, root = Fixture(spark, sf), _stream_root(spark)

    def run():
        start_live_views(_landed(spark, root), f"{root}/state", *METRIC_WINDOW, latest_ttl=LIVE_TTL, history_ttl=LIVE_HISTORY_TTL,
                         trigger={"availableNow": True}, query_name=f"q-{uuid.uuid4().hex}").awaitTermination()

    rows = raw_trades(fx)
    *early, late = time_slices(rows, SLICES)
    for part in early:
        dealt(part, FILES).write.mode("append").parquet(f"{root}/in")
    run()
    dealt(late, FILES).write.mode("append").parquet(f"{root}/in")
    closing = rows.select(F.max("timestamp") + as_interval(CLOSING)).scalar()
    sentinel(fx, closing).write.mode("append").parquet(f"{root}/in")
    run()
    return f"{root}/state"


@register("live_latest", O.with_metrics(f"""
SELECT * EXCLUDE (created_at) FROM m1
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1
    AND window_end + INTERVAL 1200500 MILLISECOND > {_WATERMARK}"""))
def q_live_latest(spark, sf):
    """O-33: latest rows in the state store, read back; symbols silent for 20 minutes have expired."""
    from .streaming.live import live_latest
    return _wall(live_latest(spark, _live(spark, sf)))


@register("live_history", O.with_metrics(f"""
SELECT * EXCLUDE (created_at, gap) FROM (
  SELECT *, coalesce(lead(window_end) OVER (PARTITION BY symbol ORDER BY window_end) - window_end > INTERVAL 6 HOUR, false) AS gap FROM m1)
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) <= 120
    AND count(*) FILTER (WHERE gap) OVER (PARTITION BY symbol ORDER BY window_end DESC) = 0
    AND {_NEWEST} + INTERVAL 6 HOUR > {_WATERMARK}"""))
def q_live_history(spark, sf):
    """O-34: the last 120 windows of every symbol in the state store, after a restart; a gap of more
    than six hours ends what came before it."""
    from .streaming.live import live_history
    return _wall(live_history(spark, _live(spark, sf)))


@register("live_top_movers", O.with_metrics(f"""
SELECT symbol, CASE WHEN low > 0 THEN (high - low) / low * 100.0::DOUBLE ELSE 0.0 END AS price_change_pct FROM m1
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1
    AND window_end + INTERVAL 1200500 MILLISECOND > {_WATERMARK}"""))
def q_live_top_movers(spark, sf):
    """O-35: scores of the symbols whose latest row has not expired."""
    from .streaming.live import live_top_movers
    return live_top_movers(spark, _live(spark, sf))


@register("pipeline_metrics", f"""WITH {O.TRADES}
SELECT 'input_rows' AS metric_name, count(*) + 1.0::DOUBLE AS metric_value FROM trades
UNION ALL SELECT 'rows_dropped_by_watermark', 0.0""")
def q_pipeline_metrics(spark, sf):
    """O-42: the progress table that a listener appends while the stream runs; over all batches the
    input is every trade and the closing one, and none is late."""
    import time

    from .sources.fixtures import land_raw_trades
    from .streaming.progress import ProgressCollector
    root = _stream_root(spark)
    land_raw_trades(Fixture(spark, sf), f"{root}/in", n_files=SLICES, files=FILES)
    listener = ProgressCollector(spark=spark, path=f"{root}/pipeline_metrics")
    spark.streams.addListener(listener)
    try:
        q = _run(spark, root, *METRIC_WINDOW)
        until = time.monotonic() + 60
        while str(q.id) not in listener.ended and time.monotonic() < until:  # events arrive after the query's end
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    rows = spark.read.parquet(f"{root}/pipeline_metrics").where(F.col("labels")["query"] == q.name)
    return (rows.where(F.col("metric_name").isin("input_rows", "rows_dropped_by_watermark"))
            .groupBy("metric_name").agg(F.sum("metric_value").alias("metric_value")))


# ---------------------------------------------------------------- stored tables
@register("stored_range", O.with_metrics(f"""
SELECT * EXCLUDE (created_at) FROM m1
WHERE window_start BETWEEN {O.AS_OF_M1} - INTERVAL 30 HOUR AND {O.AS_OF_M1} - INTERVAL 6 HOUR"""))
def q_stored_range(spark, sf):
    """O-4, O-41: the metrics table written by date and read back between two times."""
    root, fx = _stream_root(spark), Fixture(spark, sf)
    sinks.write_metrics_table(fx.metrics_table(), f"{root}/metrics")
    table = spark.read.parquet(f"{root}/metrics")
    newest = table.agg(F.max("window_end")).head()[0]
    now = F.lit(newest).cast(table.schema["window_end"].dataType)
    return sinks.read_table(spark, f"{root}/metrics", start=now - F.expr("INTERVAL 30 HOURS"),
                            end=now - F.expr("INTERVAL 6 HOURS")).select(*METRIC_COLUMNS)


@register("stored_alerts", O.with_alerts(f"""
SELECT * EXCLUDE (created_at) FROM atab WHERE detected_at >= {O.AS_OF_MH} - INTERVAL 168 HOUR"""))
def q_stored_alerts(spark, sf):
    """O-4, O-41: the alert table by its second access path, the date of detection."""
    root, fx = _stream_root(spark), Fixture(spark, sf)
    sinks.append_alerts(fx.alerts_table(), f"{root}/alerts", 0)
    now = fx.anomaly_table.agg(F.max("window_end")).head()[0]
    since = F.lit(now).cast(fx.anomaly_table.schema["window_end"].dataType) - F.expr("INTERVAL 168 HOURS")
    return sinks.read_alert_table(spark, f"{root}/alerts", since).select(*ALERT_COLS, "acknowledged")


@register("stored_compacted", O.with_metrics("SELECT * EXCLUDE (created_at) FROM m1"))
def q_stored_compacted(spark, sf):
    """O-32, O-4: the metrics table appended in batches that each reach over all dates, its earlier dates
    compacted between them twice and what was replaced deleted once, read back whole."""
    import datetime as dt

    from .operators.compaction import compact, drop_replaced
    root, fx = _stream_root(spark), Fixture(spark, sf)
    path, table = f"{root}/metrics", fx.metrics_table()
    last = table.agg(F.max("window_start")).head()[0].date()
    for batch in range(6):
        part = table.where(F.pmod(F.xxhash64("symbol", "window_start"), F.lit(6)) == batch)
        sinks.append_batch(part, path, batch, ts_col="window_start")
        if batch in (2, 4):
            compact(spark, path, last - dt.timedelta(days=6 - batch))
        if batch == 3:
            drop_replaced(spark, path, older_than_s=0)
    return sinks.read_table(spark, path).select(*METRIC_COLUMNS)


# ---------------------------------------------------------------- serving
@register("latest_symbol", O.with_metrics(f"""
SELECT '{SYMBOL}' AS symbol, coalesce(vwap, 0.0) AS vwap, coalesce(volatility, 0.0) AS volatility,
       coalesce(rsi, 50.0) AS rsi, coalesce(volume, 0) AS volume,
       coalesce(trade_count, 0) AS trade_count, coalesce(high, 0.0) AS high,
       coalesce(low, 0.0) AS low,
       epoch_ms(window_start) AS window_start, epoch_ms(window_end) AS window_end,
       epoch_ms(created_at) AS updated_at
FROM m1 WHERE symbol = '{SYMBOL}'
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1
   AND epoch_ms(created_at) >= epoch_ms({O.AS_OF_M1} - INTERVAL 1 HOUR)"""))
def q_latest_symbol(spark, sf):
    """O-43: latest metrics of one symbol from the latest-state view."""
    fx = Fixture(spark, sf)
    st = views.latest_state(fx.metrics_table(), as_of=fx.as_of(), ttl="1 hour")
    return S.latest(st, SYMBOL.lower())


@register("history_range", O.with_metrics(f"""
SELECT * EXCLUDE (created_at) FROM m1
WHERE symbol = '{SYMBOL}' AND window_start >= {O.AS_OF_M1} - INTERVAL 24 HOUR
  AND window_start <= {O.AS_OF_M1}
ORDER BY window_start DESC LIMIT 100"""))
def q_history_range(spark, sf):
    """O-44: one symbol's windows in [as_of-24h, as_of], newest 100."""
    fx = Fixture(spark, sf)
    now = fx.as_of()
    since = now - F.expr("INTERVAL 24 HOURS")
    return S.history(fx.metrics_table(since=since), SYMBOL, start=since, end=now, limit=100)


_ALERT_SEL = ("symbol, alert_type, severity, coalesce(z_score, 0.0) AS z_score, "
              "coalesce(threshold, 0.0) AS threshold, nullif(current_value, 0.0) AS current_value, "
              "nullif(baseline_value, 0.0) AS baseline_value, window_start, window_end, detected_at, "
              "acknowledged")


@register("alerts_filtered", O.with_alerts(f"""
SELECT {_ALERT_SEL} FROM atab
WHERE detected_at >= {O.AS_OF_MH} - INTERVAL 168 HOUR AND severity = 'CRITICAL'
ORDER BY detected_at DESC, symbol, alert_type LIMIT 50"""))
def q_alerts_filtered(spark, sf):
    """O-46/O-47: CRITICAL alerts of the last 7 days, newest 50, response defaults."""
    a, now = _alert_panel(spark, sf, "168 hours")
    return S.alerts(a, severity="critical", hours=168, limit=50, as_of=now, with_message=False).drop("id")


@register("alerts_recent", O.with_alerts(f"""
SELECT {_ALERT_SEL} FROM atab
WHERE detected_at >= {O.AS_OF_MH} - INTERVAL 24 HOUR
ORDER BY detected_at DESC, symbol, alert_type LIMIT 50"""))
def q_alerts_recent(spark, sf):
    """O-46: default alert listing (24 h, 50 rows, no predicates)."""
    a, now = _alert_panel(spark, sf, "24 hours")
    return S.alerts(a, as_of=now, with_message=False).drop("id")


@register("alert_summary", O.with_alerts(f"""
SELECT symbol, severity, alert_type, count(*) AS alert_count, max(detected_at) AS last_detected
FROM atab WHERE detected_at >= {O.AS_OF_MH} - INTERVAL 168 HOUR
GROUP BY symbol, severity, alert_type"""))
def q_alert_summary(spark, sf):
    """O-48: alert counts per (symbol, severity, type), last 7 days."""
    a, now = _alert_panel(spark, sf, "168 hours")
    return S.alert_summary(a, hours=168, as_of=now)


@register("recent_metrics", O.with_metrics(f"""
SELECT symbol, window_start, vwap, volatility, volume FROM m1
WHERE window_start >= {O.AS_OF_M1} - INTERVAL 1 HOUR
ORDER BY window_start DESC, symbol LIMIT 100"""))
def q_recent_metrics(spark, sf):
    """O-49: all symbols' windows of the last hour, newest 100."""
    fx = Fixture(spark, sf)
    now = fx.as_of()
    return S.recent_metrics(fx.metrics_table(since=now - F.expr("INTERVAL 1 HOUR")), as_of=now)


# ---------------------------------------------------------------- dashboards
def _fx(spark, sf):
    """The metrics of the longest look-back of these panels, and NOW()."""
    fx = Fixture(spark, sf)
    now = fx.as_of()
    return fx, fx.metrics_table(since=now - F.expr("INTERVAL 6 HOURS")), now


_RANGE_M1 = f"window_start BETWEEN {O.AS_OF_M1} - INTERVAL 6 HOUR AND {O.AS_OF_M1}"


@register("dash_vwap_series", O.with_metrics(
    f"SELECT window_start AS time, symbol, vwap AS value FROM m1 WHERE {_RANGE_M1} ORDER BY time, symbol"))
def q_dash_vwap_series(spark, sf):
    """O-50: VWAP series of all symbols, last 6 h."""
    _, m, now = _fx(spark, sf)
    return D.vwap_series(m, as_of=now, lookback="6 hours")


@register("dash_volume_series", O.with_metrics(
    f"SELECT window_start AS time, symbol, volume AS value FROM m1 WHERE {_RANGE_M1} ORDER BY time, symbol"))
def q_dash_volume_series(spark, sf):
    """O-51: volume series of all symbols, last 6 h."""
    _, m, now = _fx(spark, sf)
    return D.volume_series(m, as_of=now, lookback="6 hours")


@register("dash_avg_volatility", O.with_metrics(
    f"SELECT avg(volatility) AS value FROM m1 WHERE window_start >= {O.AS_OF_M1} - INTERVAL 5 MINUTE"))
def q_dash_avg_volatility(spark, sf):
    """O-52: mean volatility of the last 5 minutes."""
    _, m, now = _fx(spark, sf)
    return D.avg_volatility(m, as_of=now)


@register("dash_alert_count", O.with_alerts(
    f"SELECT count(*) AS value FROM atab WHERE detected_at >= {O.AS_OF_MH} - INTERVAL 24 HOUR"))
def q_dash_alert_count(spark, sf):
    """O-53: alerts detected in the look-back (24 h for the fixture)."""
    a, now = _alert_panel(spark, sf, "24 hours")
    return D.alert_count(a, as_of=now, lookback="24 hours")


@register("dash_alerts_by_severity", O.with_alerts(
    f"SELECT severity, count(*) AS count FROM atab WHERE detected_at >= {O.AS_OF_MH} - INTERVAL 24 HOUR "
    "GROUP BY severity"))
def q_dash_alerts_by_severity(spark, sf):
    """O-54: alerts per severity, last 24 h."""
    a, now = _alert_panel(spark, sf, "24 hours")
    return D.alerts_by_severity(a, as_of=now)


@register("dash_total_trades", O.with_metrics(
    f"SELECT CAST(sum(trade_count) AS BIGINT) AS value FROM m1 "
    f"WHERE window_start >= {O.AS_OF_M1} - INTERVAL 1 HOUR"))
def q_dash_total_trades(spark, sf):
    """O-55: trades counted in windows of the last hour."""
    _, m, now = _fx(spark, sf)
    return D.total_trades(m, as_of=now)


@register("dash_recent_alerts", O.with_alerts(
    f"SELECT detected_at, symbol, alert_type, severity, z_score FROM atab "
    f"WHERE detected_at >= {O.AS_OF_MH} - INTERVAL 24 HOUR "
    "ORDER BY detected_at DESC, symbol, alert_type LIMIT 20"))
def q_dash_recent_alerts(spark, sf):
    """O-56: the 20 most recent alerts (24 h look-back; message checked separately)."""
    a, now = _alert_panel(spark, sf, "24 hours")
    return D.recent_alerts(a, as_of=now, lookback="24 hours", with_message=False)


@register("dash_symbols", O.with_metrics("SELECT DISTINCT symbol FROM m1 ORDER BY symbol"))
def q_dash_symbols(spark, sf):
    """O-57: distinct symbols."""
    return D.symbols(Fixture(spark, sf).metrics_table())


@register("dash_symbol_price", O.with_metrics(
    f"SELECT window_start AS time, vwap, high, low FROM m1 WHERE symbol = '{SYMBOL}' AND {_RANGE_M1} "
    "ORDER BY time"))
def q_dash_symbol_price(spark, sf):
    """O-58: one symbol's VWAP/high/low series, last 6 h."""
    _, m, now = _fx(spark, sf)
    return D.symbol_price(m, SYMBOL, as_of=now, lookback="6 hours")


@register("dash_symbol_current", O.with_metrics(
    f"SELECT vwap, rsi FROM m1 WHERE symbol = '{SYMBOL}' ORDER BY window_start DESC LIMIT 1"))
def q_dash_symbol_current(spark, sf):
    """O-59: one symbol's current VWAP and RSI."""
    return D.symbol_current(Fixture(spark, sf).metrics_table(), SYMBOL)


@register("dash_symbol_series", O.with_metrics(
    f"SELECT window_start AS time, volatility, rsi, volume FROM m1 WHERE symbol = '{SYMBOL}' "
    f"AND {_RANGE_M1} ORDER BY time"))
def q_dash_symbol_series(spark, sf):
    """O-60: one symbol's volatility / rsi / volume series, last 6 h."""
    _, m, now = _fx(spark, sf)
    return D.symbol_series(m, SYMBOL, as_of=now, lookback="6 hours")


@register("dash_symbol_alerts", O.with_alerts(
    f"SELECT detected_at, alert_type, severity, z_score FROM atab WHERE symbol = '{SYMBOL}' "
    f"AND detected_at BETWEEN {O.AS_OF_MH} - INTERVAL 168 HOUR AND {O.AS_OF_MH} "
    "ORDER BY detected_at DESC, alert_type LIMIT 10"))
def q_dash_symbol_alerts(spark, sf):
    """O-61: one symbol's 10 latest alerts in the last 7 days."""
    a, now = _alert_panel(spark, sf, "168 hours")
    return D.symbol_alerts(a, SYMBOL, as_of=now, lookback="168 hours", with_message=False)


@register("dash_stream_status", O.with_metrics(
    "SELECT CASE WHEN count(*) > 0 THEN 'Active' ELSE 'Stalled' END AS pipeline_status FROM m1 "
    f"WHERE window_start >= {O.AS_OF_M1} - INTERVAL 2 MINUTE"))
def q_dash_stream_status(spark, sf):
    """O-62: Active / Stalled."""
    _, m, now = _fx(spark, sf)
    return D.stream_status(m, as_of=now)


@register("dash_events_processed", O.with_metrics(
    f"SELECT window_start AS time, CAST(sum(trade_count) AS BIGINT) AS events_processed FROM m1 "
    f"WHERE {_RANGE_M1} GROUP BY window_start ORDER BY time"))
def q_dash_events_processed(spark, sf):
    """O-63: trades per window start, last 6 h."""
    _, m, now = _fx(spark, sf)
    return D.events_processed(m, as_of=now, lookback="6 hours")


@register("dash_active_symbols", O.with_metrics(
    f"SELECT count(DISTINCT symbol) AS active_symbols FROM m1 "
    f"WHERE window_start >= {O.AS_OF_M1} - INTERVAL 1 HOUR"))
def q_dash_active_symbols(spark, sf):
    """O-64: exact distinct symbols (1 h look-back for the fixture)."""
    _, m, now = _fx(spark, sf)
    return D.active_symbols(m, as_of=now, lookback="1 hour")


@register("dash_avg_window_size", O.with_metrics(
    f"SELECT round(avg(trade_count)) AS avg_trades_per_window FROM m1 "
    f"WHERE window_start >= {O.AS_OF_M1} - INTERVAL 1 HOUR"))
def q_dash_avg_window_size(spark, sf):
    """O-65: ROUND(AVG(trade_count)) (1 h look-back for the fixture)."""
    _, m, now = _fx(spark, sf)
    return D.avg_window_size(m, as_of=now, lookback="1 hour")


@register("dash_alert_rate", O.with_alerts(
    f"SELECT date_trunc('minute', detected_at) AS time, severity, count(*) AS count FROM atab "
    f"WHERE detected_at BETWEEN {O.AS_OF_MH} - INTERVAL 168 HOUR AND {O.AS_OF_MH} "
    "GROUP BY 1, 2 ORDER BY 1, 2"))
def q_dash_alert_rate(spark, sf):
    """O-66: alerts per minute and severity, last 7 days."""
    a, now = _alert_panel(spark, sf, "168 hours")
    return D.alert_rate(a, as_of=now, lookback="168 hours")


@register("dash_processing_lag", O.with_metrics(
    f"SELECT window_start AS time, epoch(created_at - window_end) AS processing_lag_s FROM m1 "
    f"WHERE {_RANGE_M1} ORDER BY time"))
def q_dash_processing_lag(spark, sf):
    """O-67: seconds from window end to write, last 6 h."""
    _, m, now = _fx(spark, sf)
    return D.processing_lag(m, as_of=now, lookback="6 hours")


@register("dash_freshness", O.with_metrics(
    f"SELECT epoch({O.AS_OF_M1} - max(created_at)) AS staleness_s FROM m1"))
def q_dash_freshness(spark, sf):
    """O-68: seconds since the newest write."""
    _, m, now = _fx(spark, sf)
    return D.freshness(m, as_of=now)


# ---------------------------------------------------------------- sources
@register("quotes_normalized", """
SELECT upper(event_type) AS symbol, value AS price,
       coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS volume,
       ts AS event_time, 'UNKNOWN' AS exchange
FROM events WHERE coalesce(value, 0.0) > 0""")
def q_quotes_normalized(spark, sf):
    """O-5: quote JSON payloads -> trades. The payloads are stand-in input built
    from the events rows (price/volume as quote strings); normalize_quotes does the work."""
    ev = Fixture(spark, sf).table("events")
    payload = F.to_json(F.struct(F.struct(
        F.col("value").cast("string").alias("05. price"),
        F.get_json_object("props", "$.k").alias("06. volume")).alias("Global Quote")))
    landed = ev.select(F.upper("event_type").alias("symbol"), payload.alias("payload"),
                       F.col("ts").alias("received_at"))
    return normalize_quotes(landed, received_at="received_at").drop("trade_id")


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
