"""Fixed row contracts of the pipeline (raw trade, trade, metrics, alerts, ...)."""

from pyspark.sql import types as T

# Alert enums and severities as the reference defines them.
ALERT_TYPES = ("PRICE_ANOMALY", "VOLUME_SPIKE", "VOLATILITY_SPIKE")
SEVERITIES = ("INFO", "WARNING", "CRITICAL")

# Fixed value: Avro record of a raw trade on the wire (timestamp-millis logical type).
RAW_TRADE_AVRO = """{
  "type": "record",
  "name": "RawTrade",
  "fields": [
    {"name": "symbol",    "type": "string"},
    {"name": "price",     "type": "double"},
    {"name": "volume",    "type": "long"},
    {"name": "timestamp", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "exchange",  "type": "string"},
    {"name": "trade_id",  "type": "string"}
  ]
}"""

RAW_TRADE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("trade_id", T.StringType()),
])

TRADES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("trade_id", T.StringType()),
])

# The columns of the stored and sent tables.
METRIC_COLUMNS = ["symbol", "window_start", "window_end", "vwap", "volatility", "rsi",
                  "volume", "trade_count", "high", "low"]

METRICS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("volatility", T.DoubleType()),
    T.StructField("rsi", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("trade_count", T.LongType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
])

ALERT_COLUMNS = ["symbol", "alert_type", "severity", "z_score", "threshold", "current_value",
                 "baseline_value", "message", "window_start", "window_end", "detected_at"]

ALERTS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("alert_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("current_value", T.DoubleType()),
    T.StructField("baseline_value", T.DoubleType()),
    T.StructField("message", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("detected_at", T.TimestampType()),
])

# Alerts as they travel in JSON: timestamps may be ISO strings or epoch millis,
# so every field is read as a string first and converted afterwards.
ALERT_JSON = T.StructType([T.StructField(f.name, T.StringType()) for f in ALERTS.fields])

# Fixed value: the pipeline metric row.
PIPELINE_METRICS = T.StructType([
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_value", T.DoubleType(), False),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("recorded_at", T.TimestampType()),
])

TOP_MOVERS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price_change_pct", T.DoubleType()),
])
