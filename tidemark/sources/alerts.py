"""Alert stream decode (O-3): JSON values -> ALERTS rows, malformed rows split off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import ALERT_JSON

_NUMERIC = ("z_score", "threshold", "current_value", "baseline_value")
_TIMES = ("window_start", "window_end", "detected_at")
CORRUPT = "_corrupt_record"


def _to_ts(s: Column) -> Column:
    """ISO-8601 text or epoch milliseconds -> timestamp (both forms occur on the wire)."""
    millis = s.try_cast("bigint")
    return F.coalesce(F.timestamp_millis(millis), F.try_to_timestamp(s))


def decode_alerts(df: DataFrame, value: str = "value") -> DataFrame:
    """Every row of ``df`` as an ALERTS row with a last column ``_corrupt_record``: null for an alert,
    the text (all alert columns null) where it is not a JSON object or lacks symbol / alert_type."""
    text = F.col(value).cast("string")
    parsed = df.select(text.alias("raw"), F.from_json(text, ALERT_JSON, {"mode": "PERMISSIVE"}).alias("a"))
    ok = F.col("a").isNotNull() & F.col("a.symbol").isNotNull() & F.col("a.alert_type").isNotNull()
    cols = []
    for f in ALERT_JSON.fields:
        c = F.col(f"a.{f.name}")
        if f.name in _NUMERIC:
            c = c.try_cast("double")
        elif f.name in _TIMES:
            c = _to_ts(c)
        cols.append(F.when(ok, c).alias(f.name))
    return parsed.select(*cols, F.when(~F.coalesce(ok, F.lit(False)), F.coalesce("raw", F.lit(""))).alias(CORRUPT))


def split_alerts(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alerts, corrupt texts) of :func:`decode_alerts`."""
    return (decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT), decoded.where(F.col(CORRUPT).isNotNull()).select(CORRUPT))


def parse_alert_json(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split ``df[value]`` (JSON text or bytes) into (good ALERTS rows, corrupt rows): the consumer
    logged and skipped malformed values instead of failing."""
    return split_alerts(decode_alerts(df, value))


# Fixed value: the reference's consumer starts at the end of the topic. The default here loses nothing.
REFERENCE_KAFKA_OPTIONS = {"startingOffsets": "latest"}


def read_raw_alerts(spark: SparkSession, source: str, fmt: str = "text", streaming: bool = True, **options) -> DataFrame:
    """The alert topic (``fmt="kafka"``) or landed JSON lines (``fmt="text"``), undecoded (value)."""
    if fmt == "kafka":
        opts = {"subscribe": "alerts", "startingOffsets": "earliest", **options, "kafka.bootstrap.servers": source}
        return spark.readStream.format("kafka").options(**opts).load().select("value")
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).format("text").load(source).select("value")


def read_alerts(spark: SparkSession, source: str, fmt: str = "text", streaming: bool = True,
                **options) -> tuple[DataFrame, DataFrame]:
    """(good, corrupt) rows of :func:`read_raw_alerts`."""
    return parse_alert_json(read_raw_alerts(spark, source, fmt, streaming, **options))
