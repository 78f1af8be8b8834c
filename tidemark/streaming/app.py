"""The market stream (O-14 … O-19, O-28, O-32, O-33, O-36): one streaming query.

trades ─ withWatermark ─ sliding-window aggregate ─ RollingHistory (keyed state)
       ─ foreachBatch: persist once, then
           • METRICS table append      (dt / batch_id partitions, overwrite on replay)
           • keyed JSON messages       (batch_id folder, overwrite on replay)
           • latest-state snapshot     (the buckets of the batch's symbols, rewritten)
           • alerts: every signal as keyed JSON for consumers, and first-wins per de-dup key
             within the batch → anti-join with keys of earlier batches → audit append

Live history and top movers are read from these tables (:func:`read_history`,
:func:`read_top_movers`), so nothing is written twice.

The aggregation runs once (the reference ran it in four independent queries)
and every sink is idempotent per ``batch_id``, so a restart from the checkpoint
that replays a micro-batch rewrites the same partitions instead of duplicating.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from ..functions.timecols import epoch_millis
from ..operators.anomaly import HISTORY_WINDOWS, alerts_from_baseline
from ..operators.compaction import stored
from ..operators.dedup import DEDUP_TTL_SECONDS, dedup_alerts
from ..operators.sinks import append_alerts, append_batch, audit_rows, to_keyed_json
from ..operators.views import HISTORY_SIZE, latest_per_key, metric_history, top_mover_scores
from ..operators.windows import DEFAULT_SLIDE, DEFAULT_WATERMARK, DEFAULT_WINDOW, window_metrics
from ..schemas import ALERT_COLUMNS, METRIC_COLUMNS
from ..session import export_package, file_system as _fs, scratch_path
from .detector import stream_baseline

# Fixed value: the reference's micro-batch cadence.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
#: Folders that the latest state is spread over by symbol.
LATEST_BUCKETS = 16


@dataclass(frozen=True)
class StreamPaths:
    root: str

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def latest(self) -> str:
        return f"{self.root}/latest"

    @property
    def raw_alerts(self) -> str:
        return f"{self.root}/alerts_raw"

    @property
    def enriched(self) -> str:
        return f"{self.root}/enriched"

    @property
    def late(self) -> str:
        return f"{self.root}/late"


def _partition_values(spark: SparkSession, root: str, name: str) -> list[int]:
    """Integer values of ``root/name=V`` folders, in order (one directory listing)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        n = st.getPath().getName()
        if st.isDirectory() and n.startswith(name + "="):
            out.append(int(n.split("=", 1)[1]))
    return sorted(out)


def _write_latest(batch: DataFrame, paths: StreamPaths, batch_id: int, keep: int = 10,
                  buckets: int = LATEST_BUCKETS) -> None:
    """Latest row per symbol, in ``bucket=B/batch_id=N`` folders by a hash of the symbol.

    Only buckets that the batch touches are written anew, each from its newest folder below this
    batch (a replay of batch N reads what N read before). The newest ``keep`` folders of a bucket
    stay, for readers that still hold an older listing.
    """
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64("symbol"), F.lit(buckets)).cast("int")
    cur = batch.select(*METRIC_COLUMNS, F.unix_millis(F.current_timestamp()).alias("updated_at"))
    touched = sorted(r["b"] for r in cur.select(bucket.alias("b")).distinct().collect())  # at most `buckets`
    older = {b: [n for n in _partition_values(spark, f"{paths.latest}/bucket={b}", "batch_id") if n < batch_id]
             for b in touched}
    folders = [f"{paths.latest}/bucket={b}/batch_id={ns[-1]}" for b, ns in older.items() if ns]
    if folders:
        cur = cur.unionByName(spark.read.parquet(*folders).select(*cur.columns))
    snap = latest_per_key(cur, "symbol", "window_end").withColumn("bucket", bucket)
    (snap.withColumn("batch_id", F.lit(int(batch_id))).repartition("bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id").parquet(paths.latest))
    fs, _ = _fs(spark, paths.latest)
    for b, ns in older.items():
        for n in ns[:-max(keep - 1, 1)]:
            fs.delete(_fs(spark, f"{paths.latest}/bucket={b}/batch_id={n}")[1], True)


def _write_alerts(batch: DataFrame, paths: StreamPaths, batch_id: int, detected_at,
                  kafka_bootstrap: str | None = None, ttl_seconds: int = DEDUP_TTL_SECONDS) -> None:
    """Alerts of the batch, first-wins per de-dup key, minus keys of earlier batches.

    Append mode emits windows in window_end order, so every later alert starts after
    this batch's earliest window_start; keys of older 5-minute buckets can never
    match again. Keys live in a side table ``alert_keys/maxbucket=B/batch_id=N``:
    a batch reads only folders with B >= its earliest bucket and drops the others,
    so the lookup stays a few small files however long the stream runs.
    """
    spark = batch.sparkSession
    bucket = F.floor(epoch_millis("window_start") / F.lit(ttl_seconds * 1000)).cast("bigint")
    raw = alerts_from_baseline(batch, detected_at=detected_at).select(*ALERT_COLUMNS).persist()
    cached = (dedup_alerts(raw, ttl_seconds, keep_key=True).withColumn("_bucket", bucket).persist())
    keyed = cached
    try:
        # every alert goes out: de-duplication is each consumer's own
        (to_keyed_json(raw).select("value").write.mode("overwrite").text(f"{paths.raw_alerts}/batch_id={batch_id}"))
        if kafka_bootstrap:
            _to_kafka(raw, kafka_bootstrap, ALERTS_TOPIC)
        lo, hi = keyed.select(F.min("_bucket"), F.max("_bucket")).first()
        if lo is None:
            return
        keys_root = f"{paths.root}/alert_keys"
        live = [b for b in _partition_values(spark, keys_root, "maxbucket") if b >= lo]
        folders = [f"{keys_root}/maxbucket={b}" for b in live]
        if folders:
            seen = (spark.read.option("basePath", keys_root).parquet(*folders)
                    .filter(F.col("batch_id") < F.lit(batch_id)).select("dedup_key"))
            keyed = keyed.join(seen, "dedup_key", "left_anti")
        rows = audit_rows(keyed.drop("_bucket")).select(
            "id", *ALERT_COLUMNS, "dedup_key", "acknowledged", F.current_timestamp().alias("created_at"))
        append_alerts(rows, paths.alerts, batch_id)
        (keyed.select("dedup_key").write.mode("overwrite")
         .parquet(f"{keys_root}/maxbucket={hi}/batch_id={batch_id}"))
        fs, _ = _fs(spark, keys_root)
        for b in _partition_values(spark, keys_root, "maxbucket"):
            if b < lo:
                fs.delete(_fs(spark, f"{keys_root}/maxbucket={b}")[1], True)
    finally:
        cached.unpersist()
        raw.unpersist()


# Topics of the enriched-metrics and alert messages.
ENRICHED_TOPIC = "enriched-events"
ALERTS_TOPIC = "alerts"


def _to_kafka(df: DataFrame, bootstrap: str, topic: str) -> None:
    """Keyed JSON rows to a topic (needs the Kafka connector on the classpath)."""
    (to_keyed_json(df).write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .option("topic", topic).save())


@dataclass(frozen=True)
class LateRows:
    """The side output of rows behind the watermark (O-14): the windows they missed, and the
    checkpoint whose log holds the watermark of every batch."""
    checkpoint: str
    window: str
    slide: str


#: The column that carries trades beside the metrics of a batch.
_TRADE = "_trade"


def with_trades(metrics: DataFrame, trades: DataFrame, watermark: str) -> DataFrame:
    """``metrics`` with a column of trades, null there, and a row for each trade, null but for it."""
    passed = trades.withWatermark("event_time", watermark)
    beside = [F.lit(None).cast(f.dataType).alias(f.name) for f in metrics.schema.fields]
    return (metrics.withColumn(_TRADE, F.lit(None).cast(trades.schema))
            .unionByName(passed.select(*beside, F.struct(*trades.columns).alias(_TRADE))))


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Epoch milliseconds of the watermark that makes rows of a batch late: the one that the batch before
    it ran with, as the checkpoint's offset log holds it (0: none yet)."""
    path = f"{checkpoint.rstrip('/')}/offsets/{batch_id - 1}"
    fs, p = _fs(spark, path)
    if batch_id == 0 or not fs.exists(p):
        return 0
    version, about, *_ = spark.read.text(path, wholetext=True).head()[0].split("\n")
    return int(json.loads(about)["batchWatermarkMs"])


def _write_late(trades: DataFrame, late: LateRows, mark: int, paths: StreamPaths, batch_id: int) -> None:
    """A row for every window that had closed before a trade of the batch came."""
    missed = (trades.select(f"{_TRADE}.*").withColumn("_w", F.window("event_time", late.window, late.slide))
              .select("*", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")).drop("_w")
              .withColumn("watermark", F.timestamp_millis(F.lit(mark))).where(F.col("window_end") <= F.col("watermark")))
    append_batch(missed, paths.late, batch_id, ts_col="window_start")


def fan_out(paths: StreamPaths, detected_at=None, write_json: bool = True, parallel: bool = True,
            kafka_bootstrap: str | None = None, keep_snapshots: int = 10, late: LateRows | None = None):
    """foreachBatch body: persist the batch once and feed every sink from it.

    ``count()`` fills the cache (and is the empty-batch guard); the sink jobs are
    independent and are submitted concurrently, so a micro-batch costs the
    slowest sink rather than their sum. Any sink error fails the batch; the
    restart replays it and every sink rewrites its ``batch_id`` partitions.
    """

    def _run(batch: DataFrame, batch_id: int) -> None:
        sc = batch.sparkSession.sparkContext
        whole = batch
        if late:  # of the trades only those behind the watermark are kept
            mark = late_watermark(batch.sparkSession, late.checkpoint, batch_id)
            whole = batch.where(F.col(_TRADE).isNull() | (F.col(f"{_TRADE}.event_time") < F.timestamp_millis(F.lit(mark))))
        whole = whole.persist()
        try:
            batch = whole
            if late:
                _write_late(whole.where(F.col(_TRADE).isNotNull()), late, mark, paths, batch_id)
                batch = whole.where(F.col(_TRADE).isNull()).drop(_TRADE)
            if batch.count() == 0:
                return
            jobs = [
                lambda: append_batch(
                    batch.select(*METRIC_COLUMNS).withColumn("created_at", F.current_timestamp()),
                    paths.metrics, batch_id, ts_col="window_start"),
                lambda: _write_latest(batch, paths, batch_id, keep_snapshots),
                lambda: _write_alerts(batch, paths, batch_id, detected_at, kafka_bootstrap),
            ]
            if write_json:
                jobs.append(lambda: to_keyed_json(batch.select(*METRIC_COLUMNS)).write.mode("overwrite")
                            .json(f"{paths.enriched}/batch_id={batch_id}"))
            if kafka_bootstrap:
                # at-least-once like any Kafka producer; consumers de-duplicate alerts by key
                jobs.append(lambda: _to_kafka(batch.select(*METRIC_COLUMNS), kafka_bootstrap, ENRICHED_TOPIC))
            if not parallel:
                for job in jobs:
                    job()
                return
            # threads that inherit the query's local properties: stopping it cancels their jobs
            group = f"sinks-{uuid.uuid4().hex}"

            def tagged(job):
                sc.addJobTag(group)
                job()

            with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
                futures = [pool.submit(inheritable_thread_target(batch.sparkSession)(lambda j=job: tagged(j))) for job in jobs]
                done, rest = wait(futures, return_when=FIRST_EXCEPTION)
                if rest:
                    sc.cancelJobsWithTag(group)
                for fut in done:
                    fut.result()
        finally:
            whole.unpersist()

    return _run


def start_market_stream(trades_stream: DataFrame, out_root: str, checkpoint: str | None = None,
                        window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE,
                        watermark: str = DEFAULT_WATERMARK, history: int = HISTORY_WINDOWS,
                        trigger: dict | None = None, query_name: str = "market-stream",
                        detected_at: Column | str | None = None,
                        write_json: bool = True, idle_ms: int | None = None,
                        kafka_bootstrap: str | None = None, keep_snapshots: int = 10,
                        late_table: bool = False) -> StreamingQuery:
    """Start the single streaming query over a TRADES stream.

    ``checkpoint`` defaults to ``<spark.checkpoint.dir>/<query_name>``; ``trigger``
    defaults to a 10 s processing-time trigger (tests pass ``{"availableNow": True}``).
    ``detected_at`` defaults to the processing time of the micro-batch; ``keep_snapshots``
    older folders of a latest-state bucket stay for slow readers.
    ``late_table`` writes every trade that came after a window of its own had closed to
    ``out_root/late``, once for each such window (trade columns, window, watermark, ``batch_id``):
    its distinct (batch, symbol, window) are what Spark counts as dropped by the watermark. It
    reads the batch's trades a second time beside the aggregate, and keeps the late ones only.
    """
    if not trades_stream.isStreaming:
        raise ValueError("start_market_stream needs a streaming DataFrame")
    spark = export_package(trades_stream.sparkSession)
    metrics = window_metrics(trades_stream, window, slide, watermark)
    enriched = stream_baseline(metrics, history, idle_ms)
    paths = StreamPaths(out_root.rstrip("/"))
    ckpt = checkpoint or scratch_path(spark, "streams", query_name)
    late = LateRows(ckpt, window, slide) if late_table else None
    if late:
        enriched = with_trades(enriched, trades_stream, watermark)
    writer = (enriched.writeStream.queryName(query_name)
              .foreachBatch(fan_out(paths, detected_at, write_json, kafka_bootstrap=kafka_bootstrap,
                                    keep_snapshots=keep_snapshots, late=late))
              .option("checkpointLocation", ckpt)
              .outputMode("append")
              .trigger(**(trigger or DEFAULT_TRIGGER)))
    return writer.start()


def read_latest(spark: SparkSession, out_root: str, as_of=None, ttl: str | None = None) -> DataFrame:
    """Latest state: the newest folder of every bucket (optionally with the TTL predicate)."""
    root = StreamPaths(out_root.rstrip("/")).latest
    newest = {b: _partition_values(spark, f"{root}/bucket={b}", "batch_id") for b in _partition_values(spark, root, "bucket")}
    folders = [f"{root}/bucket={b}/batch_id={ns[-1]}" for b, ns in newest.items() if ns]
    if not folders:
        raise FileNotFoundError(f"no latest-state snapshot under {root}")
    snap = spark.read.parquet(*folders)
    if ttl is None:
        return snap
    from ..functions.timecols import as_interval, resolve_as_of
    now = resolve_as_of(as_of)
    return snap.filter(F.col("updated_at") >= epoch_millis(now - as_interval(ttl)))


def read_history(spark: SparkSession, out_root: str, n: int = HISTORY_SIZE) -> DataFrame:
    """Live history: the last ``n`` windows of every symbol, from the metrics table."""
    return metric_history(stored(spark, StreamPaths(out_root.rstrip("/")).metrics).select(*METRIC_COLUMNS), n)


def read_late(spark: SparkSession, out_root: str) -> DataFrame:
    """The windows that trades came too late for, a row for each trade and window."""
    return spark.read.parquet(StreamPaths(out_root.rstrip("/")).late)


def read_top_movers(spark: SparkSession, out_root: str) -> DataFrame:
    """Live top-mover scores of the latest state."""
    return top_mover_scores(read_latest(spark, out_root))


def stop_when_idle(query: StreamingQuery, timeout_s: float = 60.0, poll_s: float = 0.2) -> bool:
    """Stop ``query`` between micro-batches (graceful stop): wait until no trigger is
    active, then stop. Returns False when the timeout forced a stop mid-batch — safe
    either way, since the next start replays the uncommitted batch idempotently."""
    deadline = time.monotonic() + timeout_s
    idle = False
    while time.monotonic() < deadline and query.isActive:
        if not query.status.get("isTriggerActive", False):
            idle = True
            break
        time.sleep(poll_s)
    query.stop()
    return idle


def forget_commit(spark: SparkSession, checkpoint: str) -> int:
    """Remove the newest batch from a stopped query's commit log, so that its next start replays it, as
    after a crash between the sinks and the commit. Returns the batch's number."""
    root = f"{checkpoint.rstrip('/')}/commits"
    fs, p = _fs(spark, root)
    done = sorted(int(st.getPath().getName()) for st in fs.listStatus(p) if st.getPath().getName().isdigit())
    fs.delete(_fs(spark, f"{root}/{done[-1]}")[1], False)
    return done[-1]
