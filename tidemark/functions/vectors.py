"""Operations on feature values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the largest finite double, to which infinities are clipped.
LARGEST = 1.7976931348623157e308


def scale(x: Column, low: Column, high: Column) -> Column:
    """Min-max scaling of one value; a constant feature divides by one."""
    return (x - low) / F.when(high == low, F.lit(1.0)).otherwise(high - low)


def fill(x: Column) -> Column:
    """NaN and null become 0, infinities the largest finite value of their sign."""
    clipped = F.when(x > LARGEST, LARGEST).when(x < -LARGEST, -LARGEST).otherwise(x)
    return F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(clipped)
