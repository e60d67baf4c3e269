"""Number text for people; never feed these columns to further arithmetic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_digits(column: str) -> Column:
    """Thousands separators and exactly two decimals."""
    return F.format_number(column, 2)


def twelve_digits(column: str) -> Column:
    """Up to twelve decimals, without separators or trailing zeros."""
    return F.call_function("format_number", F.col(column), F.lit("#.############"))


def with_formatted(df: DataFrame, columns: Iterable[str], digits: int = 2) -> DataFrame:
    """Add ``<column>_formatted`` beside each column."""
    style = {2: two_digits, 12: twelve_digits}[digits]
    return df.withColumns({f"{name}_formatted": style(name) for name in columns})
