"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(col: Column | str, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` — half rounds toward +infinity.

    This is the JVM ``Math.round(x * 10^d) / 10^d`` idiom the detector uses for
    its reported numbers; it differs from ``F.round`` (half away from zero) on
    negative ties, e.g. -3.00005 -> -3.0.
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(num, den)


def severity_by_levels(value: Column, critical_above: float, warning_above: float) -> Column:
    """CRITICAL above the first level, WARNING above the second, else INFO."""
    return (F.when(value > F.lit(critical_above), F.lit("CRITICAL"))
            .when(value > F.lit(warning_above), F.lit("WARNING"))
            .otherwise(F.lit("INFO")))
