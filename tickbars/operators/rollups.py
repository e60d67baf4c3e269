"""Month and year bars, and per-asset summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.calendar import as_date, period_label, period_start
from tickbars.functions.numbers import mean_of
from tickbars.operators.quality import drop_incomplete

BAR_INPUT = ("SNo", "Name", "Date", "High", "Low", "Open", "Close", "Volume", "Marketcap")
QUOTE_INPUT = ("name1", "price", "marketCap")

# Room for the sequence number below the day number inside one 64-bit ordering key.
SEQUENCE_SPAN = 1 << 53


def _sequence_key(bars: DataFrame) -> Column:
    """Day within the period and sequence number as one long; refuses a sequence number that does not fit."""
    sequence = F.col("SNo").cast("long")
    if not isinstance(bars.schema["SNo"].dataType, T.IntegerType):
        fits = sequence.between(-(SEQUENCE_SPAN // 2), SEQUENCE_SPAN // 2 - 1)
        sequence = F.when(fits, sequence).otherwise(F.raise_error(F.lit("SNo is too large for a unique sequence")))
    return F.date_diff(F.col("Date"), F.col("period")).cast("long") * F.lit(SEQUENCE_SPAN) + sequence


def _placed(bars: DataFrame, grain: str, unique_sequence: bool) -> DataFrame:
    """Complete bars with their ``period`` and the ``position`` that orders first and last within it."""
    bars = drop_incomplete(bars.withColumn("Date", as_date(F.col("Date"))), BAR_INPUT)
    bars = bars.withColumn("period", period_start(F.col("Date"), grain))
    if unique_sequence:
        return bars.withColumn("position", _sequence_key(bars))
    return bars.withColumn("position", F.struct("Date", "SNo", "Open", "Close"))


def period_base(bars: DataFrame, grain: str, *, unique_sequence: bool = False) -> DataFrame:
    """One row per asset and period, keyed by ``name`` and the period's first day.

    First and last are by (Date, SNo), never by arrival. If (Name, Date, SNo) identifies a bar, ``unique_sequence=True``
    packs the order into one long, which keeps the whole aggregation hash-based. Otherwise the prices themselves break
    ties, which needs a wider order and hence a sort before each side of the aggregation. Either way rows are combined
    before the shuffle, so an asset holding much of the data sends one row per period and task.
    """
    bars = _placed(bars, grain, unique_sequence)
    return bars.groupBy(F.col("Name").alias("name"), "period").agg(
        F.max("High").alias("highest_high"),
        F.min("Low").alias("lowest_low"),
        F.min_by("Open", "position").alias("first_open"),
        F.max_by("Close", "position").alias("last_close"),
        F.sum("Volume").alias("total_volume"),
        F.sum("Marketcap").alias("total_marketcap"),
    )


def period_partials(bars: DataFrame, grain: str, *, unique_sequence: bool = False) -> DataFrame:
    """``period_base`` of some of the bars, with the positions of the first and last one, so that it can be merged with
    the partials of other bars."""
    return _placed(bars, grain, unique_sequence).groupBy(F.col("Name").alias("name"), "period").agg(
        F.max("High").alias("highest_high"),
        F.min("Low").alias("lowest_low"),
        F.min("position").alias("first_position"),
        F.min_by("Open", "position").alias("first_open"),
        F.max("position").alias("last_position"),
        F.max_by("Close", "position").alias("last_close"),
        F.sum("Volume").alias("total_volume"),
        F.sum("Marketcap").alias("total_marketcap"),
    )


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partials of any number of disjoint parts of the bars, put together to what ``period_base`` gives of all.

    They are dealt by asset alone, so that longer periods of the result need no shuffle of their own. An asset has at most
    one partial per part and period, which the calendar bounds.
    """
    return partials.repartition("name").groupBy("name", "period").agg(
        F.max("highest_high").alias("highest_high"),
        F.min("lowest_low").alias("lowest_low"),
        F.min_by("first_open", "first_position").alias("first_open"),
        F.max_by("last_close", "last_position").alias("last_close"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("total_marketcap").alias("total_marketcap"),
    )


def year_base_from_months(month_base: DataFrame) -> DataFrame:
    """Year rows from month rows: months are unique per asset, so their first day alone orders opens and closes."""
    return month_base.groupBy("name", period_start(F.col("period"), "year").alias("year_start")).agg(
        F.max("highest_high").alias("highest_high"),
        F.min("lowest_low").alias("lowest_low"),
        F.min_by("first_open", "period").alias("first_open"),
        F.max_by("last_close", "period").alias("last_close"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("total_marketcap").alias("total_marketcap"),
    ).withColumnRenamed("year_start", "period")


def labelled(base: DataFrame, grain: str) -> DataFrame:
    """Replace the period's first day by its text label, once per result row."""
    return base.select(
        "name",
        period_label(F.col("period"), grain).alias(grain),
        "highest_high",
        "lowest_low",
        "first_open",
        "last_close",
        "total_volume",
        "total_marketcap",
    )


def bars_by_month(bars: DataFrame, *, unique_sequence: bool = False) -> DataFrame:
    return labelled(period_base(bars, "month", unique_sequence=unique_sequence), "month")


def bars_by_year(bars: DataFrame, *, unique_sequence: bool = False) -> DataFrame:
    return labelled(period_base(bars, "year", unique_sequence=unique_sequence), "year")


def asset_summary(quotes: DataFrame) -> DataFrame:
    """Mean, lowest and highest price and highest market capitalisation of each asset."""
    quotes = drop_incomplete(quotes.select(*QUOTE_INPUT), QUOTE_INPUT)
    return quotes.groupBy(F.col("name1").alias("name")).agg(
        mean_of(quotes, "price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.max("marketCap").alias("max_market_cap"),
    )
