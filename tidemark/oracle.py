"""DuckDB formulations of the registered queries (the correctness oracle).

Each string runs on the driver tables registered as views (``events`` ...).
The CTE chain mirrors the DataFrame pipeline: trades -> sliding windows ->
rolling baseline -> alerts -> de-dup -> serving/dashboard query.
Sliding windows: every trade is crossed with its window/slide bucket offsets.
"""

from __future__ import annotations

from .functions.timecols import duration_seconds
from .sources.fixtures import ANOMALY_WINDOW, METRIC_WINDOW, WRITE_LAG

LAG_S = int(duration_seconds(WRITE_LAG))

TRADES = """trades AS (
  SELECT upper(event_type) AS symbol, value AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume,
         ts AS event_time, 'X' || CAST(user_id % 5 AS VARCHAR) AS exchange,
         CAST(event_id AS VARCHAR) AS trade_id
  FROM events WHERE upper(event_type) IS NOT NULL AND value > 0)"""


def _half_up(value: str, places: int) -> str:
    """Half-up rounding of the decimal digits a double prints as, which SQL round on doubles,
    multiplying first, misses just below a tie."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


def _metrics(name: str, window: str, slide: str) -> str:
    w, s = int(duration_seconds(window)), int(duration_seconds(slide))
    return f"""{name} AS (
  SELECT symbol, ws AS window_start, ws + INTERVAL {w} SECOND AS window_end,
         {_half_up("list_reduce(list(price * volume ORDER BY CAST(trade_id AS BIGINT)) FILTER (WHERE volume IS NOT NULL),"
                   " lambda a, b: a + b) / nullif(sum(volume), 0)", 6)} AS vwap,
         {_half_up("coalesce(stddev_pop(price), 0.0)", 8)} AS volatility,
         {_half_up("CASE WHEN max(price) - min(price) = 0 THEN 50.0::DOUBLE ELSE (avg(price) - min(price))"
                   " / (max(price) - min(price)) * 100.0::DOUBLE END", 2)} AS rsi,
         CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trade_count,
         {_half_up("max(price)", 6)} AS high, {_half_up("min(price)", 6)} AS low,
         ws + INTERVAL {w + LAG_S} SECOND AS created_at
  FROM (SELECT t.*,
               time_bucket(INTERVAL {s} SECOND, event_time, TIMESTAMP '1970-01-01')
                 - r.i * INTERVAL {s} SECOND AS ws
        FROM trades t, range({w // s}) r(i))
  GROUP BY symbol, ws)"""


M1 = _metrics("m1", *METRIC_WINDOW)
MH = _metrics("mh", *ANOMALY_WINDOW)

def _base(source: str = "mh", partition: str = "symbol") -> str:
    """Stats of the 20 rows before each; means as the sum in history order over the count."""
    return f"""base AS (
  SELECT * EXCLUDE (vs, ts), list_reduce(vs, lambda a, b: a + b) / len(vs) AS price_mean,
         list_reduce(ts, lambda a, b: a + b) / len(ts) AS volatility_mean
  FROM (SELECT symbol, window_start, window_end, vwap, volume, volatility,
               count(*) OVER w AS hist_n, count(vwap) OVER w AS price_n,
               stddev_pop(vwap) OVER w AS price_std, avg(volume) OVER w AS volume_mean,
               list(vwap) FILTER (WHERE vwap IS NOT NULL) OVER w AS vs,
               list(volatility) FILTER (WHERE volatility IS NOT NULL) OVER w AS ts
        FROM {source}
        WINDOW w AS (PARTITION BY {partition} ORDER BY window_end ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)))"""


BASE = _base()

# history segments: a new segment starts after a gap longer than the reset interval
SEGMENTS = """gapd AS (
  SELECT *, CASE WHEN window_end - lag(window_end) OVER (PARTITION BY symbol ORDER BY window_end)
                      > INTERVAL {reset_s} SECOND THEN 1 ELSE 0 END AS gap
  FROM mh),
segd AS (
  SELECT *, sum(gap) OVER (PARTITION BY symbol ORDER BY window_end ROWS UNBOUNDED PRECEDING) AS seg
  FROM gapd)"""

ALERTS = """sig AS (
  SELECT *, (vwap - price_mean) / price_std AS z, volume / volume_mean AS vr,
         volatility / volatility_mean AS tr
  FROM base),
alerts AS (
  SELECT symbol, 'PRICE_ANOMALY' AS alert_type,
         CASE WHEN abs(z) > 4.0 THEN 'CRITICAL' WHEN abs(z) > 3.0 THEN 'WARNING' ELSE 'INFO' END AS severity,
         floor(z * 10000.0 + 0.5) / 10000.0 AS z_score, CAST(3.0 AS DOUBLE) AS threshold,
         vwap AS current_value, floor(price_mean * 1000000.0 + 0.5) / 1000000.0 AS baseline_value,
         window_start, window_end, window_end AS detected_at
  FROM sig WHERE price_n > 0 AND price_std > 0 AND abs(z) > 3.0
  UNION ALL
  SELECT symbol, 'VOLUME_SPIKE',
         CASE WHEN vr > 10.0 THEN 'CRITICAL' WHEN vr > 7.0 THEN 'WARNING' ELSE 'INFO' END,
         floor(vr * 10000.0 + 0.5) / 10000.0, CAST(5.0 AS DOUBLE), CAST(volume AS DOUBLE),
         floor(volume_mean * 100.0 + 0.5) / 100.0, window_start, window_end, window_end
  FROM sig WHERE hist_n > 0 AND volume_mean > 0 AND volume > volume_mean * 5.0
  UNION ALL
  SELECT symbol, 'VOLATILITY_SPIKE',
         CASE WHEN tr > 6.0 THEN 'CRITICAL' WHEN tr > 4.0 THEN 'WARNING' ELSE 'INFO' END,
         floor(tr * 10000.0 + 0.5) / 10000.0, CAST(3.0 AS DOUBLE),
         floor(volatility * 100000000.0 + 0.5) / 100000000.0,
         floor(volatility_mean * 100000000.0 + 0.5) / 100000000.0, window_start, window_end, window_end
  FROM sig WHERE hist_n > 0 AND volatility_mean > 0 AND volatility > volatility_mean * 3.0)"""

KEYED = """keyed AS (
  SELECT *, 'alert:dedup:' || md5(symbol || ':' || alert_type || ':' ||
            CAST(CAST(floor(epoch_ms(window_start) / 300000) AS BIGINT) AS VARCHAR)) AS dedup_key
  FROM alerts),
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dedup_key
             ORDER BY window_start NULLS FIRST, window_end NULLS FIRST, detected_at NULLS FIRST,
                      symbol NULLS FIRST, alert_type NULLS FIRST, severity NULLS FIRST,
                      z_score NULLS FIRST, threshold NULLS FIRST, current_value NULLS FIRST,
                      baseline_value NULLS FIRST) AS rn
    FROM keyed) WHERE rn = 1),
atab AS (
  SELECT symbol, alert_type, severity, z_score, threshold, current_value, baseline_value,
         window_start, window_end, detected_at, false AS acknowledged,
         window_end + INTERVAL %d SECOND AS created_at
  FROM deduped)""" % LAG_S

def _shown(value: str, places: int) -> str:
    """The digits of a fixed-point format: half-up on the decimal digits, all places shown."""
    return (f"CAST(CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {places})"
            f" AS DECIMAL(38,{places})) AS VARCHAR)")


# message text per alert: fixed values, the reference's formats
MESSAGES = f"""messages AS (
  SELECT symbol, 'PRICE_ANOMALY' AS alert_type, window_end, CASE WHEN abs(z) > 4.0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
         symbol || ' VWAP anomaly: Z-score=' || {_shown("z", 4)} || ', current=$' || {_shown("vwap", 2)}
         || ', baseline=$' || {_shown("price_mean", 2)} AS message
  FROM sig WHERE price_n > 0 AND price_std > 0 AND abs(z) > 3.0
  UNION ALL
  SELECT symbol, 'VOLUME_SPIKE', window_end, CASE WHEN vr > 10.0 THEN 'CRITICAL' WHEN vr > 7.0 THEN 'WARNING' ELSE 'INFO' END,
         symbol || ' volume spike: ' || {_shown("vr", 1)} || 'x above average (current=' || volume
         || ', avg=' || CAST(trunc(volume_mean) AS BIGINT) || ')'
  FROM sig WHERE hist_n > 0 AND volume_mean > 0 AND volume > volume_mean * 5.0
  UNION ALL
  SELECT symbol, 'VOLATILITY_SPIKE', window_end, CASE WHEN tr > 6.0 THEN 'CRITICAL' WHEN tr > 4.0 THEN 'WARNING' ELSE 'INFO' END,
         symbol || ' volatility spike: ' || {_shown("tr", 1)} || 'x above rolling average'
  FROM sig WHERE hist_n > 0 AND volatility_mean > 0 AND volatility > volatility_mean * 3.0)"""

AS_OF_M1 = "(SELECT max(window_end) FROM m1)"
AS_OF_MH = "(SELECT max(window_end) FROM mh)"


def with_metrics(body: str) -> str:
    return f"WITH {TRADES},\n{M1}\n{body}"


REPLAYED = ALERTS.replace("alerts AS (", "sent AS (") + """,
alerts AS (
  SELECT * FROM sent
  UNION ALL SELECT * REPLACE (detected_at + INTERVAL 10 SECOND AS detected_at) FROM sent)"""


def with_alerts(body: str, alerts: str = ALERTS) -> str:
    return f"WITH {TRADES},\n{MH},\n{BASE},\n{alerts},\n{KEYED}\n{body}"


def with_messages(body: str) -> str:
    return f"WITH {TRADES},\n{MH},\n{BASE},\n{ALERTS},\n{MESSAGES}\n{body}"
