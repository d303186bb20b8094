"""Volatility measures: mean, sample standard deviation, count, coefficient of variation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cv(mean: Column, std: Column) -> Column:
    """std / mean; NULL where the mean is 0 or missing."""
    return F.try_divide(std, mean)


def cv_or_zero(mean: Column, std: Column) -> Column:
    """std / mean; 0 where the mean is 0 or missing."""
    return F.when(mean != 0, std / mean).otherwise(F.lit(0.0))


def moments(price: str) -> list[Column]:
    return [
        F.avg(price).alias("mean"),
        F.stddev_samp(price).alias("std"),
        F.count(price).alias("count"),
    ]
