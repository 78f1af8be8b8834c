"""The alert consumer (O-3, O-29, O-30, O-36, O-37): alert stream -> parse -> first-wins
de-dup -> audit table and annotation payloads, one streaming query.

Every alert of the producer arrives; de-duplication is the consumer's own, in its keyed state
(:func:`tidemark.streaming.detector.first_alerts`), so any number of consumers see the same stream
and no first alert is too late.
Where the stream is that of :func:`tidemark.sources.alerts.decode_alerts`, malformed rows come out of
the same batch into their own folder, ``dead_letters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.compaction import stored
from ..operators.dedup import DEDUP_TTL_SECONDS
from ..operators.sinks import alert_annotations, append_alerts, audit_rows
from ..schemas import ALERT_COLUMNS
from ..sources.alerts import CORRUPT, split_alerts
from ..session import export_package, scratch_path
from .detector import REMEMBER_MS, first_alerts


def start_alert_consumer(alerts_stream: DataFrame, out_root: str, checkpoint: str | None = None,
                         ttl_seconds: int = DEDUP_TTL_SECONDS, trigger: dict | None = None,
                         query_name: str = "alert-consumer", remember_ms: int = REMEMBER_MS) -> StreamingQuery:
    """Consume an ALERTS stream (see :func:`tidemark.sources.read_alerts`), or one of decoded rows,
    good and malformed together (:func:`tidemark.sources.alerts.decode_alerts`).

    Writes ``out_root/audit`` (alerts with a stable ``id``, acknowledged = false),
    ``out_root/annotations`` (JSON payloads) and ``out_root/dead_letters`` (the texts of malformed
    rows), all overwritten per batch on replay.
    The first alert of a de-dup key wins, however late it comes; the key is remembered for
    ``remember_ms`` in the state store, which a replayed batch finds as it was before it.
    """
    if not alerts_stream.isStreaming:
        raise ValueError("start_alert_consumer needs a streaming DataFrame")
    root = out_root.rstrip("/")
    export_package(alerts_stream.sparkSession)
    decoded = CORRUPT in alerts_stream.columns
    columns = [*ALERT_COLUMNS, CORRUPT] if decoded else ALERT_COLUMNS
    fresh = first_alerts(alerts_stream.select(*columns), ttl_seconds, remember_ms, CORRUPT if decoded else None)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            good = batch
            if decoded:
                good, bad = split_alerts(batch)
                bad.write.mode("overwrite").parquet(f"{root}/dead_letters/batch_id={batch_id}")
            rows = audit_rows(good).select("id", *ALERT_COLUMNS, "dedup_key", "acknowledged",
                                           F.current_timestamp().alias("created_at"))
            append_alerts(rows, f"{root}/audit", batch_id)
            alert_annotations(good).write.mode("overwrite").json(f"{root}/annotations/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (fresh.writeStream.queryName(query_name).foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint or scratch_path(alerts_stream.sparkSession, "streams", query_name))
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def read_audit(spark: SparkSession, out_root: str) -> DataFrame:
    """The audit table of a consumer."""
    return stored(spark, f"{out_root.rstrip('/')}/audit")


def read_dead_letters(spark: SparkSession, out_root: str) -> DataFrame:
    """The malformed rows of a consumer, each as its text, with the batch that held it."""
    return spark.read.parquet(f"{out_root.rstrip('/')}/dead_letters")
