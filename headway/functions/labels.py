"""Delay labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def three_way_label(delay_seconds: Column, tolerance: float = 300.0) -> Column:
    """early up to and including -tolerance, on-time up to and including tolerance, else delayed."""
    return (
        F.when(delay_seconds <= -tolerance, "early")
        .when(delay_seconds <= tolerance, "on-time")
        .when(delay_seconds > tolerance, "delayed")
    )


def delayed_class(label: Column) -> Column:
    """1 for "delayed", 0 for the other labels and for null."""
    return F.coalesce(label == "delayed", F.lit(False)).cast("int")


def late_by(delay_minutes: Column, threshold: float) -> Column:
    """1 when the delay reaches the threshold."""
    return (delay_minutes >= threshold).cast("int")
