"""Sinks (O-31, O-32, O-36, O-37, O-41): keyed JSON, idempotent table appends,
alert audit rows, annotation payloads and the partitioned storage layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timecols import epoch_millis, time_range_filter, utc_date
from .compaction import stored

# JDBC append options of the reference's metrics sink.
JDBC_OPTIONS = {"batchsize": "1000", "reWriteBatchedInserts": "true", "driver": "org.postgresql.Driver"}


def to_keyed_json(df: DataFrame, key: str = "symbol") -> DataFrame:
    """(key, value) rows for a message sink: ``key`` column and ``to_json(struct(*))``."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def with_partition_date(df: DataFrame, ts_col: str = "window_start") -> DataFrame:
    """``dt``, the UTC date of ``ts_col``: the same whatever zone writer and reader run in."""
    return df.withColumn("dt", utc_date(F.col(ts_col)))


def write_metrics_table(df: DataFrame, path: str, mode: str = "append", batch_id: int | None = None,
                        ts_col: str = "window_start", more: dict[str, str] | None = None) -> None:
    """Persist METRICS as Parquet partitioned by ``dt`` (O-41).

    Rows are range-partitioned by (dt, symbol) and sorted by (symbol, window_start)
    inside each file: a large day is spread over several tasks and files, each file
    covers a contiguous symbol range (file-level min/max pruning on symbol) and
    row groups prune on time. AQE coalesces the small writes of a micro-batch.

    With ``batch_id`` the rows land in ``batch_id=N`` under each date and a replay
    of the same micro-batch overwrites exactly that partition (idempotent). ``more`` names
    further date partitions and their timestamp columns.
    """
    out = with_partition_date(df, ts_col)
    parts = ["dt"]
    for name, source in (more or {}).items():
        out = out.withColumn(name, utc_date(F.col(source)))
        parts.append(name)
    writer_df = out
    if batch_id is not None:
        writer_df = out.withColumn("batch_id", F.lit(int(batch_id)))
        parts.append("batch_id")
    (writer_df.repartitionByRange("dt", "symbol").sortWithinPartitions("dt", "symbol", ts_col)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(path))


def append_batch(df: DataFrame, path: str, batch_id: int, ts_col: str, more: dict[str, str] | None = None) -> None:
    """Idempotent micro-batch append: dynamic overwrite of (dt, batch_id) partitions."""
    write_metrics_table(df, path, mode="overwrite", batch_id=batch_id, ts_col=ts_col, more=more)


#: The second date of alert tables: listings look back from now by the time of detection (O-41).
ALERT_DATES = {"detected_dt": "detected_at"}


def append_alerts(df: DataFrame, path: str, batch_id: int) -> None:
    """Append alert rows by the dates of their window and of their detection; a replayed batch
    replaces the partitions that it writes."""
    append_batch(df, path, batch_id, ts_col="window_start", more=ALERT_DATES)


def read_alert_table(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """The alerts detected from ``since`` to ``until`` (columns or values); only folders of those
    dates are read."""
    df = stored(spark, path)
    kind = df.schema["detected_at"].dataType
    lo, hi = (None if t is None else t if isinstance(t, Column) else F.lit(t).cast(kind) for t in (since, until))
    return time_range_filter(df, "detected_at", lo, hi)


def read_table(spark: SparkSession, path: str, ts_col: str = "window_start",
               start=None, end=None) -> DataFrame:
    """Read a dt-partitioned table; time bounds are also applied to ``dt`` so the
    scan prunes partitions (a predicate on the timestamp alone cannot)."""
    df = stored(spark, path)
    if start is not None:
        s = start if isinstance(start, Column) else F.lit(start).cast(df.schema[ts_col].dataType)
        df = df.filter((F.col("dt") >= utc_date(s)) & (F.col(ts_col) >= s))
    if end is not None:
        e = end if isinstance(end, Column) else F.lit(end).cast(df.schema[ts_col].dataType)
        df = df.filter((F.col("dt") <= utc_date(e)) & (F.col(ts_col) <= e))
    return df


def write_jdbc(df: DataFrame, url: str, table: str, user: str, password: str, **extra) -> None:
    """JDBC append with the reference's batching options (driver jar must be on the classpath)."""
    (df.write.mode("append").format("jdbc")
       .options(url=url, dbtable=table, user=user, password=password, **{**JDBC_OPTIONS, **extra})
       .save())


def audit_rows(alerts: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Alert audit rows (O-36): the 11 alert columns plus acknowledged=false and
    detected_at defaulted to now when absent; ``id`` is a non-negative bigint, a hash of what
    identifies the alert, so that a replay of its batch gives it again."""
    if "detected_at" in alerts.columns:
        # keep the column's own type (timestamp or timestamp_ntz)
        now = F.current_timestamp().cast(alerts.schema["detected_at"].dataType)
        det = F.coalesce(F.col("detected_at"), now)
    else:
        det = F.current_timestamp()
    cols = {"detected_at": det, "acknowledged": F.lit(False), "id": alert_id()}
    if created_at is not None:
        cols["created_at"] = created_at
    return alerts.withColumns(cols)


def alert_id() -> Column:
    return F.xxhash64("symbol", "alert_type", epoch_millis("window_start"),
                      epoch_millis("window_end")).bitwiseAND(F.lit((1 << 63) - 1))


def alert_annotations(alerts: DataFrame) -> DataFrame:
    """Dashboard annotation payloads (O-37): time = detected_at ms, tags, text, global scope."""
    return alerts.select(
        F.lit("").alias("dashboardUID"),
        F.coalesce(epoch_millis("detected_at"), F.unix_millis(F.current_timestamp())).alias("time"),
        F.array(F.col("alert_type"), F.col("severity"), F.col("symbol")).alias("tags"),
        F.coalesce(F.col("message"), F.lit("Anomaly detected")).alias("text"),
    )
