"""Trade sources (O-1, O-2) and the trade projection / validity filter (O-6, O-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import RAW_TRADE, RAW_TRADE_AVRO

# The topic, and the options the reference reads it with. Those skip rows the
# broker has expired and cap a batch, so they are not the defaults here: pass them by name.
KAFKA_TRADE_OPTIONS = {"subscribe": "raw-trades", "startingOffsets": "earliest", "failOnDataLoss": "true"}
REFERENCE_KAFKA_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "100000"}
# Schema-registry wire format: 1 magic byte + 4-byte schema id before the payload.
WIRE_HEADER_BYTES = 5


def read_trades(spark: SparkSession, source: str, fmt: str = "parquet", streaming: bool = True,
                **options) -> DataFrame:
    """Read raw trades.

    ``fmt="kafka"``: ``source`` is the bootstrap server list; returns Kafka rows
    (key, value, timestamp, ...) to be passed to :func:`decode_framed_avro`.
    ``fmt="parquet"|"json"``: ``source`` is a folder of landed raw trades with the
    RAW_TRADE schema (no inference); ``maxFilesPerTrigger`` bounds a micro-batch
    the way ``maxOffsetsPerTrigger`` does for Kafka.
    """
    if fmt == "kafka":
        if not streaming:
            raise ValueError("the trade topic is read as a stream")
        opts = {**KAFKA_TRADE_OPTIONS, **options, "kafka.bootstrap.servers": source}
        return spark.readStream.format("kafka").options(**opts).load()
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unsupported trade format: {fmt}")
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(RAW_TRADE).options(**options)
    return reader.format(fmt).load(source)


def strip_wire_header(value: Column | str = "value") -> Column:
    """Drop the 5-byte registry header from a framed binary value (SQL substring is 1-based)."""
    c = F.col(value) if isinstance(value, str) else value
    return F.substring(c, WIRE_HEADER_BYTES + 1, 2_147_483_647)


def decode_framed_avro(kafka_rows: DataFrame, schema_json: str = RAW_TRADE_AVRO,
                       mode: str = "FAILFAST") -> DataFrame:
    """Kafka rows -> (trade struct fields..., kafka_timestamp).

    Needs the spark-avro module on the classpath (``--packages org.apache.spark:spark-avro``).
    FAILFAST (default) fails the batch on a bad payload, as the original job does.
    """
    from pyspark.sql.avro.functions import from_avro

    trade = from_avro(strip_wire_header("value"), schema_json, {"mode": mode})
    decoded = kafka_rows.select(trade.alias("trade"), F.col("timestamp").alias("kafka_timestamp"))
    return decoded.select("trade.*", "kafka_timestamp")


def clean_trades(raw: DataFrame, event_time: str = "kafka_timestamp") -> DataFrame:
    """Project to the TRADES contract and drop invalid rows.

    ``event_time`` names the column used as event time; the original job uses
    the broker ingestion time and discards the trade's own timestamp.
    Rows with a NULL symbol or a NULL / non-positive price are dropped.
    """
    return (raw.select(
                F.col("symbol"),
                F.col("price").cast("double").alias("price"),
                F.col("volume").cast("bigint").alias("volume"),
                F.col(event_time).alias("event_time"),
                F.col("exchange"),
                F.col("trade_id"))
            .filter(F.col("symbol").isNotNull() & (F.col("price") > 0)))
