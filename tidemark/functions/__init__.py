"""Column-level helpers (JVM-side expressions only, no Python UDFs)."""

from .numeric import round_half_up, severity_by_levels, safe_ratio
from .timecols import (as_interval, duration_seconds, epoch_millis, epoch_seconds_between,
                       resolve_as_of, time_bucket)

__all__ = [
    "round_half_up", "severity_by_levels", "safe_ratio",
    "as_interval", "duration_seconds", "epoch_millis", "epoch_seconds_between",
    "resolve_as_of", "time_bucket",
]
