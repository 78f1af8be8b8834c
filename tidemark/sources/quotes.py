"""Quote normalisation (O-5): landed quote JSON -> TRADES-shaped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def normalize_quotes(df: DataFrame, payload: str = "payload", symbol: str = "symbol",
                     received_at: str | Column | None = None) -> DataFrame:
    """``{"Global Quote": {"05. price": "175.50", "06. volume": "1000"}}`` -> trade rows.

    An empty / missing quote object or a price <= 0 drops the row; a missing
    price or volume field counts as 0; exchange is 'UNKNOWN'; a fresh UUID is
    the trade id; the trade time is ``received_at`` (default: now).
    """
    quote = F.get_json_object(F.col(payload), "$['Global Quote']")
    price = F.coalesce(F.get_json_object(F.col(payload), "$['Global Quote']['05. price']")
                       .try_cast("double"), F.lit(0.0))
    volume = F.coalesce(F.get_json_object(F.col(payload), "$['Global Quote']['06. volume']")
                        .try_cast("bigint"), F.lit(0).cast("bigint"))
    ts = (F.current_timestamp() if received_at is None
          else (F.col(received_at) if isinstance(received_at, str) else received_at))
    non_empty = quote.isNotNull() & (F.regexp_replace(quote, r"\s", "") != F.lit("{}"))
    return (df.filter(non_empty)
              .select(F.col(symbol).alias("symbol"), price.alias("price"), volume.alias("volume"),
                      ts.alias("event_time"), F.lit("UNKNOWN").alias("exchange"),
                      F.expr("uuid()").alias("trade_id"))
              .filter(F.col("price") > 0))
