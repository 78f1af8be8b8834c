import datetime as dt

from pyspark.sql import functions as F

from tidemark.schemas import TRADES

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def ts(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def trades_df(spark, rows):
    """rows: (symbol, price, volume, seconds_after_T0)"""
    data = [(s, float(p), int(v) if v is not None else None, ts(t), "X0", f"t{i}")
            for i, (s, p, v, t) in enumerate(rows)]
    return spark.createDataFrame(data, TRADES)


def metrics_df(spark, rows):
    """rows: (symbol, window_end_seconds, vwap, volume, volatility) with 30 s windows."""
    data = [(s, ts(e - 30), ts(e), None if vw is None else float(vw), vo, float(vt))
            for (s, e, vw, vo, vt) in rows]
    return spark.createDataFrame(
        data, "symbol string, window_start timestamp, window_end timestamp, vwap double, "
              "volume bigint, volatility double")


def collect_sorted(df, *cols):
    return [r.asDict() for r in df.orderBy(*cols).collect()]


def col_values(df, c, order):
    return [r[c] for r in df.orderBy(*order).select(c, *order).collect()]


__all__ = ["F", "ts", "trades_df", "metrics_df", "collect_sorted", "col_values", "T0"]
