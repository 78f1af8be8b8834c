"""Alert de-duplication (O-29, O-30).

Key = md5("symbol:alert_type:bucket") with bucket = floor(window_start_ms / ttl_ms);
severity is not part of the key. First alert per key wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.timecols import epoch_millis

# 300 s de-dup TTL / bucket width and the key prefix of the reference.
DEDUP_TTL_SECONDS = 300
DEDUP_KEY_PREFIX = "alert:dedup:"


def dedup_key(ttl_seconds: int = DEDUP_TTL_SECONDS):
    bucket = F.floor(epoch_millis("window_start") / F.lit(ttl_seconds * 1000)).cast("bigint")
    raw = F.concat_ws(":", F.col("symbol"), F.col("alert_type"), bucket.cast("string"))
    return F.concat(F.lit(DEDUP_KEY_PREFIX), F.md5(raw))


def with_dedup_key(alerts: DataFrame, ttl_seconds: int = DEDUP_TTL_SECONDS) -> DataFrame:
    return alerts.withColumn("dedup_key", dedup_key(ttl_seconds))


def dedup_alerts(alerts: DataFrame, ttl_seconds: int = DEDUP_TTL_SECONDS,
                 order_by: tuple[str, ...] = ("window_start", "window_end", "detected_at"),
                 keep_key: bool = False) -> DataFrame:
    """Batch first-wins de-duplication.

    Implemented as ``groupBy(dedup_key).agg(min(struct(order..., row...)))``: a
    hash aggregate with map-side partial combine, so a key repeated millions of
    times still ships one partial row per task (no group is collected).
    The struct comparison is a total order over the whole row, so the winner is
    deterministic. Streams use :func:`tidemark.streaming.detector.dedup_stream`.
    """
    keyed = with_dedup_key(alerts, ttl_seconds)
    cols = [c for c in alerts.columns]
    ordering = [c for c in order_by if c in cols]
    rest = [c for c in cols if c not in ordering]
    packed = F.struct(*[F.col(c) for c in ordering], *[F.col(c) for c in rest])
    out = (keyed.groupBy("dedup_key").agg(F.min(packed).alias("_w"))
                .select("dedup_key", *[F.col(f"_w.{c}").alias(c) for c in cols]))
    return out if keep_key else out.drop("dedup_key")
