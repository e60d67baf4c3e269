"""Aggregates over prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mean_of(df: DataFrame, column: str) -> Column:
    """Arithmetic mean as a double.

    A decimal column is summed exactly and divided once, so the result does not depend on row order, and a sum beyond
    38 digits gives NULL instead of ending a stream. A double column takes Spark's ``avg``.
    """
    if isinstance(df.schema[column].dataType, T.DecimalType):
        return F.try_divide(F.try_sum(column).cast("double"), F.count(column).cast("double"))
    return F.avg(column)


def geometric_mean(column: str) -> Column:
    """Mean of the logarithms; ``ln`` of zero or less is NULL and so left out."""
    return F.exp(F.avg(F.ln(F.col(column).cast("double"))))


def harmonic_mean(column: str) -> Column:
    price = F.col(column).cast("double")
    return F.try_divide(F.lit(1.0), F.avg(F.try_divide(F.lit(1.0), price)))


def sample_deviation(column: str) -> Column:
    """Sample deviation; NULL for a single value."""
    return F.stddev_samp(F.col(column).cast("double"))
