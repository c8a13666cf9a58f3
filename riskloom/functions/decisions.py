"""Decision and risk band of a probability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bands are relative to the operating threshold.
LOW_BAND = 0.5
HIGH_BAND = 2.0


def decision(p: Column, threshold: Column) -> Column:
    """``flag`` at or above the threshold."""
    return F.when(p >= threshold, "flag").otherwise("no_flag")


def risk_band(p: Column, threshold: Column) -> Column:
    """low below half the threshold, medium below twice it, else high."""
    return (
        F.when(p < threshold * LOW_BAND, "low")
        .when(p < threshold * HIGH_BAND, "medium")
        .otherwise("high")
    )
