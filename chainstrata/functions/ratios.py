"""Null-safe ratios, rounding and signal labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: confidence at which a score becomes an entry signal.
MIN_CONFIDENCE = 0.60
EPSILON = 1e-9


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, ratio(numerator, denominator)).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def zscore(value: Column, mean: Column, deviation: Column) -> Column:
    return ratio(value - mean, deviation)


def signal_label(probability: Column, threshold: float = MIN_CONFIDENCE) -> Column:
    return F.when(probability >= threshold, "LONG").otherwise("WAIT")


def gated_signal_label(probability: Column, z: Column, threshold: float = MIN_CONFIDENCE,
                       z_floor: float = 1.0) -> Column:
    """Entry label that also needs the fee z-score above ``z_floor``."""
    return F.when((probability >= threshold) & (z > z_floor), "LONG").otherwise("WAIT")


def log10_positive(value: Column) -> Column:
    """log10, with zero (and below) as null."""
    return F.when(value > 0, F.log10(value.cast("double")))
