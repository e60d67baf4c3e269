"""Ticks as JSON messages: parsing, building, and the reasons to set one aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.schemas import TICK

# A tick time outside this range is a unit mistake (epoch milliseconds land around the year 56,000).
EARLIEST = "2009-01-01"
LATEST = "2100-01-01"


def parse_ticks(messages: DataFrame, value: str = "value", *, keep: tuple[str, ...] = ()) -> DataFrame:
    """One tick row per message, bytes or text; anything unreadable becomes NULL in its field.

    ``keep`` names message columns to carry along, such as the raw text for a quarantine table.
    """
    text = F.col(value).cast("string")
    parsed = messages.select(*keep, F.from_json(text, TICK, {"mode": "PERMISSIVE"}).alias("tick"))
    return parsed.select(*keep, "tick.*")


def reject_reason(earliest: str = EARLIEST, latest: str = LATEST) -> Column:
    """Why a tick cannot be stored, or NULL if it can: the keys of the result tables have to be present and sane."""
    time = F.col("time_stamp")
    return (
        F.when(F.col("name_coin").isNull() | F.col("symbol_coin").isNull(), "missing name")
        .when(time.isNull(), "missing time")
        .when((time < F.lit(earliest).cast("timestamp")) | (time >= F.lit(latest).cast("timestamp")), "time range")
    )


def to_messages(ticks: DataFrame) -> DataFrame:
    """Keyed JSON messages: the coin id as key, every tick field as value, the time as epoch seconds."""
    fields = [
        F.unix_seconds(F.col(name).cast("timestamp")).alias(name) if name == "time_stamp" else F.col(name)
        for name in TICK.fieldNames()
    ]
    return ticks.select(F.col("id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
