"""Periods of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period label formats of the month and year tables.
LABEL_FORMATS = {"month": "yyyy-MM", "year": "yyyy"}


def as_date(column: Column) -> Column:
    """A date from a date, a timestamp or ``yyyy-MM-dd`` text with or without a time; NULL for other text."""
    return column.try_cast("date")


def period_start(column: Column, grain: str) -> Column:
    """First day of the month or year: a plain date, far cheaper to group on than its text label."""
    if grain not in LABEL_FORMATS:
        raise ValueError(f"grain must be one of {sorted(LABEL_FORMATS)}, not {grain!r}")
    return F.trunc(column, grain)


def period_label(column: Column, grain: str) -> Column:
    return F.date_format(column, LABEL_FORMATS[grain])
