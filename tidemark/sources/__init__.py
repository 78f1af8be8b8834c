"""Sources: trade and alert streams/tables, framed Avro, quote JSON, test fixtures."""

from .trades import clean_trades, decode_framed_avro, read_trades, strip_wire_header
from .alerts import parse_alert_json, read_alerts
from .quotes import normalize_quotes

__all__ = ["clean_trades", "decode_framed_avro", "read_trades", "strip_wire_header",
           "parse_alert_json", "read_alerts", "normalize_quotes"]
