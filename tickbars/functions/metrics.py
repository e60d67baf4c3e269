"""Ratio metrics of a tick."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, *, percent: bool = False, as_type: str = "double") -> Column:
    """``numerator / denominator``, NULL when the denominator is zero or a decimal result has too many digits.

    ``"double"`` divides as doubles, the type result tables store; ``"decimal"`` keeps Spark's decimal division, whose
    result for decimal(38,18) operands has six decimals.
    """
    if as_type == "double":
        numerator, denominator = numerator.cast("double"), denominator.cast("double")
    elif as_type != "decimal":
        raise ValueError(f"as_type must be 'double' or 'decimal', not {as_type!r}")
    if percent:
        numerator = F.try_multiply(F.lit(100), numerator)
    return F.try_divide(numerator, denominator)


def percent_volume(as_type: str = "double") -> Column:
    return ratio(F.col("volume"), F.col("total_24_volume"), percent=True, as_type=as_type)


def percent_market_cap(as_type: str = "double") -> Column:
    return ratio(F.col("market_cap"), F.col("total_market_cap"), percent=True, as_type=as_type)


def percent_change(as_type: str = "double") -> Column:
    """Change since ``price_old``. The difference keeps 18 decimals (Spark would drop one from two decimal(38,18)); it is
    NULL for a price of 20 digits or more before the point."""
    exact = [F.col(name).try_cast("decimal(37,18)") for name in ("price", "price_old")]
    return ratio(exact[0] - exact[1], F.col("price_old"), percent=True, as_type=as_type)


def circulating_supply(as_type: str = "double") -> Column:
    return ratio(F.col("market_cap"), F.col("price"), as_type=as_type)
