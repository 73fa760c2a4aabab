"""Numeric expressions that keep null as null."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(value: Column, dtype: str = "double") -> Column:
    """Number, or null for text that is not one."""
    return finite(value.try_cast(dtype))


def finite(value: Column) -> Column:
    """NaN and the infinities become null; NaN orders above every number."""
    return F.when(F.abs(value) < float("inf"), value)


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def right_closed_bin(value: Column, edges: Sequence[float]) -> Column:
    """1-based bin of (edge, next edge]; the first bin also holds its lower edge.

    Null outside the edges. Comparisons against literal edges, so no value moves
    across an edge by a rounding error of a division.
    """
    result = F.when(value < edges[0], None)
    for number, upper in enumerate(edges[1:], start=1):
        result = result.when(value <= upper, number)
    return result


def equal_width_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of an equal-width histogram over [low, high]; the top edge is in the last bin."""
    if high <= low:
        return F.when(value.isNotNull(), 0)
    position = F.floor((value - low) / F.lit(high - low) * bins).cast("int")
    return F.least(position, F.when(value.isNotNull(), bins - 1))


def wind_parts(degrees: Column, fill_missing: bool = False) -> tuple[Column, Column]:
    """Sine and cosine of a compass direction; a missing one is north if ``fill_missing``."""
    angle = F.radians(F.coalesce(degrees, F.lit(0.0)) if fill_missing else degrees)
    return F.sin(angle), F.cos(angle)


def rainy_rush_hour(rain: Column, hour: Column) -> Column:
    """1 when more than 0.2 mm fall in a rush hour (7-9, 16-18); missing inputs count as none."""
    rush = hour.between(7, 9) | hour.between(16, 18)
    return F.coalesce((rain > 0.2) & rush, F.lit(False)).cast("int")


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def log_loss(label: Column, probability: Column, eps: float = 1e-12) -> Column:
    """Loss of one row; ``eps`` keeps the logarithms finite."""
    return -(label * F.log(probability + eps) + (1 - label) * F.log(1 - probability + eps))
